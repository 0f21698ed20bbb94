"""Column-level quality profile and distribution change between loads (problem 3).

Values of all profiled columns are unpivoted to (field, load, value) and counted; equal
values collapse on the map side, so a value that makes up a third of all rows is a handful
of rows here. The counted values are range-sorted by (field, value) and frozen together
with their partition number. Prefix counts then come in two steps: running sums inside a
partition, plus the sums of the partitions before it. Both are exact, and no task sees
more than one range partition:

* quantiles: the value at which the cumulative count of a load passes a rank;
* distinct counts: the number of counted values;
* Kolmogorov-Smirnov distance between a load and the load before it: every counted value
  is an event of two comparisons (as "current" of its load, as "reference" of the next);
  merged in value order, the two cumulative curves give the largest gap exactly.

Results for odd input: rows with a null load are in no load; null elements and null arrays
give no value but the cell still counts as seen; NaN counts as one value above infinity;
-0.0 equals 0.0. A load without values has null quantiles and distance. An empty table
gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.session import cut, shuffle_partitions

INF = float("inf")


def finite(v: Column) -> Column:
    return ~F.isnan(v) & (v != INF) & (v != -INF)


def counted(cells: DataFrame, value: str = "value") -> DataFrame:
    """(field, load, value, n) of ``cells(field, load, values ARRAY<DOUBLE>)``."""
    got = cells.where("load is not null").select("field", "load", F.explode("values").alias(value)).where(F.col(value).isNotNull())
    return got.withColumn(value, F.col(value) + F.lit(0.0)).groupBy("field", "load", value).agg(F.count(F.lit(1)).alias("n"))


def range_sorted(counts: DataFrame, partitions: int | None = None) -> DataFrame:
    """``counts`` in (field, value) order, frozen with the partition number ``pid``."""
    n = partitions or shuffle_partitions(counts.sparkSession)
    return cut(counts.repartitionByRange(n, "field", "value").sortWithinPartitions("field", "value").withColumn("pid", F.spark_partition_id()))


def prefixed(sorted_counts: DataFrame, by: list[str], columns: dict[str, str], total: bool = True) -> DataFrame:
    """Adds, per group ``by``, running sums over the values in order.

    ``columns`` maps a count column to the name of its running sum; equal values are peers
    and see the same sum. With ``total`` the group totals are added as ``<name>_total``.
    """
    local = Window.partitionBy("pid", *by).orderBy("value").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sorted_counts.groupBy("pid", *by).agg(*[F.sum(c).alias(f"_{c}") for c in columns])
    # At most one row per partition and group.
    before = Window.partitionBy(*by).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = sums.select("pid", *by, *[F.coalesce(F.sum(f"_{c}").over(before), F.lit(0)).alias(f"_{c}0") for c in columns], *[F.sum(f"_{c}").over(whole).alias(f"{o}_total") for c, o in columns.items() if total])
    got = sorted_counts.withColumns({o: F.sum(c).over(local) for c, o in columns.items()}).join(offsets, ["pid", *by])
    return got.withColumns({o: F.col(o) + F.col(f"_{c}0") for c, o in columns.items()}).drop(*[f"_{c}0" for c in columns])


def quantiles(sorted_counts: DataFrame, probs: dict[str, float], by: tuple[str, ...] = ("field", "load")) -> DataFrame:
    """Exact interpolated quantiles per group: one column per entry of ``probs``."""
    got = prefixed(sorted_counts, list(by), {"n": "cum"})
    low, n = F.col("cum") - F.col("n"), F.col("cum_total")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= low) & (rank < F.col("cum")), F.col("value")))

    aggs = []
    for name, p in probs.items():
        pos = F.lit(p) * (n - 1)
        aggs += [at(F.floor(pos)).alias(f"_{name}a"), at(F.ceil(pos)).alias(f"_{name}b"), F.first(pos - F.floor(pos)).alias(f"_{name}f")]
    out = got.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n_distinct"), F.sum("n").alias("n_values"), F.min("value").alias("min_value"), F.max("value").alias("max_value"))
    mid = lambda m: F.when(F.col(f"_{m}f") == 0, F.col(f"_{m}a")).otherwise(F.col(f"_{m}a") + (F.col(f"_{m}b") - F.col(f"_{m}a")) * F.col(f"_{m}f"))
    return out.select(*by, "n_values", "n_distinct", "min_value", "max_value", *[mid(m).alias(m) for m in probs])


def drift(sorted_counts: DataFrame, loads: DataFrame) -> DataFrame:
    """(field, load, ks): exact distance of every load to the load before it.

    ``loads(load, next_load)`` gives the order; a comparison without values on either side
    has no row.
    """
    shape = ["field", "value", "pid"]
    events = sorted_counts.join(loads, "load").select(
        *shape, F.explode(F.array(F.struct(F.col("load"), F.col("n").alias("cur"), F.lit(0).cast("long").alias("ref")), F.struct(F.col("next_load").alias("load"), F.lit(0).cast("long").alias("cur"), F.col("n").alias("ref")))).alias("e")
    )
    events = events.select(*shape, "e.*").where("load is not null")
    both = prefixed(events, ["field", "load"], {"cur": "c", "ref": "r"}).where("c_total > 0 and r_total > 0")
    return both.groupBy("field", "load").agg(F.max(F.abs(F.col("c") / F.col("c_total") - F.col("r") / F.col("r_total"))).alias("ks"))


def load_order(cells: DataFrame) -> DataFrame:
    """(load, next_load). One row per load, so the single-task order is over loads only."""
    return cells.where("load is not null").select("load").distinct().select("load", F.lead("load").over(Window.orderBy("load")).alias("next_load"))


# ---- the exposures of papers ------------------------------------------------------------

FIELDS = ["fundamental_frequency_khz", *[f"{b}.{m}" for b in ("free_field", "in_situ", "unspecified_domain") for m in ("pressure_kpa", "isppa_w_cm2")]]
# The labels of state that the data model knows.
STATES = ("value", "not_reported", "na")


def exposure_cells(papers: DataFrame) -> DataFrame:
    """(field, load, state, present, values): one cell per non-null exposure and field."""
    measure = lambda x, f: reduce(lambda c, part: c[part], f.split("."), x)
    each = papers.select(F.col("load_id").alias("load"), F.explode("exposures").alias("x")).where("x is not null")
    cells = F.array(*[F.struct(F.lit(f).alias("field"), measure(F.col("x"), f).alias("m")) for f in FIELDS])
    got = each.select("load", F.explode(cells).alias("c"))
    return got.select("c.field", "load", F.col("c.m").isNotNull().alias("present"), F.col("c.m.state").alias("state"), F.filter(F.coalesce("c.m.vals", F.array().cast("array<double>")), lambda v: v.isNotNull()).alias("values"))


def cell_rates(cells: DataFrame) -> DataFrame:
    """Per field and load: cells, cells without a value, measures, measures with an odd state."""
    return (
        cells.where("load is not null")
        .groupBy("field", "load")
        .agg(F.count(F.lit(1)).alias("n_cells"), F.count_if(F.size("values") == 0).alias("n_missing"), F.count_if("present").alias("n_measures"), F.count_if(F.col("present") & F.coalesce(~F.col("state").isin(*STATES), F.lit(False))).alias("n_odd_state"))
    )


def value_rates(counts: DataFrame) -> DataFrame:
    """Per field and load: values, the largest count of one number, invalid values."""
    bad = ~finite(F.col("value")) | (F.col("value") <= 0)
    return counts.groupBy("field", "load").agg(F.sum("n").alias("n_values"), F.max("n").alias("n_most"), F.sum(F.when(bad, F.col("n")).otherwise(0)).alias("n_invalid"))


def profile(papers: DataFrame) -> DataFrame:
    """One row per field and load: rates, exact distinct count, range, quartiles, distance."""
    cells = exposure_cells(papers)
    counts = range_sorted(counted(cells))
    shape = quantiles(counts, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    got = cell_rates(cells).join(value_rates(counts).drop("n_values"), ["field", "load"], "left").join(shape, ["field", "load"], "left").join(drift(counts, load_order(cells)), ["field", "load"], "left")
    return got.select(
        F.col("load").alias("load_id"), "field", "n_cells", (F.col("n_missing") / F.col("n_cells")).alias("missing_share"), F.try_divide("n_odd_state", "n_measures").alias("odd_state_share"),
        F.coalesce("n_values", F.lit(0)).alias("n_values"), F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"), "min_value", "max_value", "q25", "median", "q75", F.try_divide("n_invalid", "n_values").alias("invalid_share"), "ks",
    )


def issues(papers: DataFrame, missing: float = 0.3, state: float = 0.1, repeat: float = 0.3, invalid: float = 0.1, scale: float = 5.0, least: int = 10) -> DataFrame:
    """(load_id, field, issue): the loads in which a field went wrong.

    The medians of a load come from the range-sorted prefix counts; the medians over loads
    are over one row per load and field.
    """
    cells = exposure_cells(papers)
    counts = range_sorted(counted(cells))
    good = counts.where(finite(F.col("value")) & (F.col("value") > 0))
    mid = quantiles(good, {"median": 0.5}).select("field", "load", "median")
    over = Window.partitionBy("field")
    rates = cell_rates(cells).withColumn("share", F.col("n_missing") / F.col("n_cells")).withColumn("usual", F.median("share").over(over))
    got = rates.join(value_rates(counts), ["field", "load"], "left").join(mid, ["field", "load"], "left")
    enough = F.coalesce(F.col("n_values") >= least, F.lit(False))
    got = got.withColumn("mid", F.when(enough, F.col("median"))).withColumn("usual_mid", F.median("mid").over(over))
    share = lambda a, b: F.try_divide(F.col(a), F.col(b))
    tests = {
        "missing": F.col("share") - F.col("usual") >= missing,
        "state": share("n_odd_state", "n_measures") >= state,
        "repeat": enough & (share("n_most", "n_values") >= repeat),
        "invalid": enough & (share("n_invalid", "n_values") >= invalid),
        "scale": (F.col("mid") >= scale * F.col("usual_mid")) | (F.col("mid") * scale <= F.col("usual_mid")),
    }
    found = F.array_compact(F.array(*[F.when(t, F.lit(i)) for i, t in tests.items()]))
    return got.select(F.col("load").cast("int").alias("load_id"), "field", F.explode(found).alias("issue"))
