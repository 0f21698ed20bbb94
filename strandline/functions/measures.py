"""Three-state measures: a value or list of values, not reported, or not applicable.

A measure is STRUCT<state, vals, is_list>. States are compared after trimming and
lower-casing; a null measure is not applicable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Density times speed of sound of water, for intensity from pressure, in kg/(m2 s).
RHO_C = 1.5e6
MEASURE = "struct<state:string,vals:array<double>,is_list:boolean>"


def state(m: Column) -> Column:
    return F.coalesce(F.lower(F.trim(m.state)), F.lit("na"))


def numbers(m: Column) -> Column:
    """The finite and infinite numbers of a measure, nulls and NaN left out; never null."""
    return F.coalesce(F.filter(m.vals, lambda v: v.isNotNull() & ~F.isnan(v)), F.array().cast("array<double>"))


def scalar(m: Column) -> Column:
    """The value, if the measure is reported and no list."""
    return F.when((state(m) == "value") & ~F.coalesce(m.is_list, F.lit(False)), F.get(numbers(m), F.lit(0)))


def swept(m: Column) -> Column:
    return F.coalesce((state(m) == "value") & m.is_list & (F.size(numbers(m)) > 1), F.lit(False))


def any_between(m: Column, low: float | None, high: float | None) -> Column:
    """Some value of the list lies in the range; a list with a gap round it does not."""
    inside = lambda v: (F.lit(True) if low is None else v >= low) & (F.lit(True) if high is None else v <= high)
    return F.exists(numbers(m), inside)


def summary(m: Column) -> Column:
    """STRUCT<lo, hi, n>; null without numbers."""
    v = numbers(m)
    return F.when(F.size(v) > 0, F.struct(F.array_min(v).alias("lo"), F.array_max(v).alias("hi"), F.size(v).alias("n")))


def close(a: Column, b: Column, tolerance: float = 0.02) -> Column:
    """Equal within a share of the larger magnitude."""
    return F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1e-9))


def same_value(a: Column, b: Column) -> Column:
    """Two measures agree: same state; lists as sets, a list of one distinct value as that
    value, single values within tolerance."""
    u, v = F.array_sort(F.array_distinct(numbers(a))), F.array_sort(F.array_distinct(numbers(b)))
    one = (F.size(u) == 1) & (F.size(v) == 1)
    return F.when(one, close(F.get(u, F.lit(0)), F.get(v, F.lit(0)))).when((F.size(u) == 0) & (F.size(v) == 0), state(a) == state(b)).otherwise(u == v)


def half_up(x: Column, digits: int) -> Column:
    """Rounded half up on the binary value: the same in every engine with IEEE doubles."""
    f = float(10**digits)
    return F.floor(x * f + 0.5) / f


def duty_cycle(duration_ms: Column, rate_hz: Column) -> Column:
    return half_up(duration_ms * rate_hz / 10, 3)


def differs(computed: Column, stated: Column, share: float = 0.05) -> Column:
    """Relative difference above ``share`` of a stated value above 0, else null."""
    return F.when(stated > 0, F.abs(computed - stated) / stated > share)


def implied_duration(duty_pct: Column, rate_hz: Column) -> Column:
    return half_up(F.try_divide(duty_pct * 10, rate_hz), 4)


def intensity(pressure_kpa: Column) -> Column:
    """Intensity in W/cm2 of a plane wave of that pressure."""
    return F.pow(pressure_kpa * 1e3, 2) / (2 * RHO_C) / 1e4


def intensity_odd(pressure_kpa: Column, isppa: Column, factor: float = 2.0) -> Column:
    """Stated intensity off the pressure's by more than ``factor``."""
    return F.when((pressure_kpa > 0) & isppa.isNotNull(), ~F.coalesce(F.try_divide(intensity(pressure_kpa), isppa).between(1 / factor, factor), F.lit(False)))


def from_variant(v: Column) -> Column:
    """A polymorphic JSON value (number, list, text or null) as a measure."""
    kind = F.schema_of_variant(v)
    is_list = F.startswith(kind, F.lit("ARRAY"))
    num = kind.rlike("^(BIGINT|DOUBLE|DECIMAL|FLOAT)")
    vals = F.when(num, F.array(F.try_variant_get(v, "$", "double"))).when(is_list, F.try_variant_get(v, "$", "array<double>"))
    text = F.lower(F.trim(F.try_variant_get(v, "$", "string")))
    st = F.when(num | is_list, "value").when(kind == "STRING", F.when(text == "not_reported", "not_reported").otherwise("na")).otherwise("na")
    return F.struct(st.alias("state"), vals.alias("vals"), F.coalesce(is_list, F.lit(False)).alias("is_list"))
