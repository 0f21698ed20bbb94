"""Flat facts of nested records: exposures, measures, facets, checks, comparisons.

A path names a measure inside an exposure ("free_field.pressure_kpa"). The unpivoted form
(one row per record, exposure and path) is the base of the reporting statistics; it is made
by one generator over a literal array of paths, without a shuffle. Null exposures keep their
number and give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import measures as ms
from strandline.operators.nested import BLOCKS

LEAVES = tuple(m if b == "exposure" else f"{b}.{m}" for b, names in BLOCKS.items() for m in names)
DOMAINS = ("free_field", "in_situ", "unspecified_domain")


def at(x: Column, path: str) -> Column:
    """The field at a dotted path; a missing parent gives null."""
    return reduce(lambda c, part: c[part], path.split("."), x)


def exposures(papers: DataFrame, *keep: str) -> DataFrame:
    """One row per non-null exposure: ``keep``, exposure_no, x."""
    return papers.select(*keep, F.posexplode("exposures").alias("exposure_no", "x")).where("x is not null")


def unpivot(papers: DataFrame, *keep: str) -> DataFrame:
    """One row per exposure and measure: ``keep``, exposure_no, leaf, path, m."""
    cells = F.array(*[F.struct(F.lit(p).alias("leaf"), at(F.col("x"), p).alias("m")) for p in LEAVES])
    got = exposures(papers, *keep).select(*keep, "exposure_no", F.explode(cells).alias("c"))
    return got.select(*keep, "exposure_no", "c.leaf", F.concat(F.lit("exposures["), "exposure_no", F.lit("]."), "c.leaf").alias("path"), "c.m")


def reporting(papers: DataFrame) -> DataFrame:
    """(leaf, applicable, not_reported, share): the two kinds of absence counted apart.

    Applicable is every measure that is not "na"; share is the part of those that is reported,
    null where nothing is applicable. The unspecified domain, which is never silent, is left out.
    """
    s = ms.state(F.col("m"))
    rows = unpivot(papers).where(~F.startswith("leaf", F.lit("unspecified_domain.")))
    got = rows.groupBy("leaf").agg(F.count_if(s != "na").alias("applicable"), F.count_if(s == "not_reported").alias("not_reported"))
    return got.withColumn("share", F.round(1 - F.try_divide("not_reported", "applicable"), 3))


def any_domain(papers: DataFrame) -> DataFrame:
    """(measure, applicable, not_reported): the three domains of a measure taken together."""
    x = F.col("x")

    def row(m: str) -> Column:
        three = F.array(*[at(x, f"{d}.{m}") for d in DOMAINS])
        known = F.exists(three, lambda v: ms.state(v).isin("value", "not_reported"))
        return F.struct(F.lit(m).alias("measure"), known.alias("known"), F.exists(three, lambda v: F.size(ms.numbers(v)) > 0).alias("numeric"))

    got = exposures(papers).select(F.explode(F.array(*[row(m) for m in BLOCKS["free_field"]])).alias("r")).select("r.*")
    return got.groupBy("measure").agg(F.count_if("known").alias("applicable"), F.count_if(F.col("known") & ~F.col("numeric")).alias("not_reported"))


def composition(df: DataFrame, facets: tuple[str, ...]) -> DataFrame:
    """(facet, value, n): rows per value of several array columns; a value repeated in one array
    counts once."""
    every = F.array(*[F.struct(F.lit(f).alias("facet"), F.array_distinct(F.coalesce(f, F.array().cast("array<string>"))).alias("vals")) for f in facets])
    return df.select(F.explode(every).alias("e")).select("e.facet", F.explode("e.vals").alias("value")).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def flat(papers: DataFrame, manifest: DataFrame, closure: DataFrame) -> DataFrame:
    """One wide row per exposure: bibliography, terms with all their ancestors, measures.

    ``closure(id, path)`` has the path from the root of every term; terms are joined one row
    each and folded back by set union, so the vocabulary is never collected.
    """
    x = F.col("x")
    sums = [ms.summary(at(x, p)).alias(p.replace(".", "_")) for p in LEAVES]
    lists = F.array_compact(F.array(*[F.when(ms.swept(at(x, p)), F.lit(p)) for p in LEAVES]))
    # Only the finished columns travel; a term that many exposures have is joined once.
    base = exposures(papers, "record_id", "citekey")
    rows = base.select("record_id", "exposure_no", "citekey", F.col("x.label").alias("label"), *sums, lists.alias("swept"))
    terms = base.select("record_id", "exposure_no", F.explode("x.target.terms").alias("id")).where("id is not null").distinct()
    known = terms.select("id").distinct().join(closure.select("id", "path"), "id")
    up = terms.join(known, "id", "left").select("record_id", "exposure_no", F.coalesce("path", F.array("id")).alias("p"))
    both = up.groupBy("record_id", "exposure_no").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("p")))).alias("target_all"))  # as many as one exposure has ancestors
    m = manifest.where("citekey is not null").groupBy("citekey").agg(F.min(F.struct("entry_id", "title", "year")).alias("b"))
    got = rows.join(both, ["record_id", "exposure_no"], "left").join(m, "citekey", "left")
    return got.select("record_id", "exposure_no", "citekey", F.col("b.title").alias("title"), F.col("b.year").alias("year"), "label", F.coalesce("target_all", F.array().cast("array<string>")).alias("target_all"), *[p.replace(".", "_") for p in LEAVES], "swept")


def checks(papers: DataFrame) -> DataFrame:
    """(record_id, exposure_no, duty_computed, duty_mismatch, duration_implied, flags): arithmetic
    checks of every exposure."""
    x = F.col("x")
    pd_, prf, dc = (ms.scalar(at(x, f"timing.{m}")) for m in ("pulse_duration_ms", "pulse_repetition_frequency_hz", "duty_cycle_pct"))
    silent = ms.state(at(x, "timing.pulse_duration_ms")) == "not_reported"
    f0 = ms.numbers(x["fundamental_frequency_khz"])
    flags = [
        (F.exists(f0, lambda v: ~v.between(20, 20000)), "f0_out_of_range"),
        (pd_ > F.try_divide(F.lit(1000.0), prf) * 1.0001, "pd_exceeds_period"),
        *[(ms.intensity_odd(ms.scalar(at(x, f"{d}.pressure_kpa")), ms.scalar(at(x, f"{d}.isppa_w_cm2"))), f"intensity_pressure_inconsistent_{d}") for d in DOMAINS],
    ]
    computed = ms.duty_cycle(pd_, prf)
    return exposures(papers, "record_id").select(
        "record_id", "exposure_no", computed.alias("duty_computed"), ms.differs(computed, dc).alias("duty_mismatch"),
        F.when(silent, ms.implied_duration(dc, prf)).alias("duration_implied"), F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(n)) for t, n in flags])).alias("flags"),
    )


def compare(first: DataFrame, second: DataFrame, key: str = "citekey") -> DataFrame:
    """(key, exposure_no, leaf, agree): two readings of the same records, measure by measure.

    Exposures are matched by position where both have as many; other records give one row with
    leaf "exposures" that does not agree.
    """
    a = first.select(key, F.col("exposures").alias("ea"))
    both = a.join(second.select(key, F.col("exposures").alias("eb")), key)
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    odd = both.where(size("ea") != size("eb")).select(key, F.lit(None).cast("int").alias("exposure_no"), F.lit("exposures").alias("leaf"), F.lit(False).alias("agree"))
    pairs = both.where((size("ea") == size("eb")) & (size("ea") > 0)).select(key, F.posexplode(F.arrays_zip("ea", "eb")).alias("exposure_no", "p")).where("p.ea is not null and p.eb is not null")
    cells = F.array(*[F.struct(F.lit(p).alias("leaf"), F.coalesce(ms.same_value(at(F.col("p.ea"), p), at(F.col("p.eb"), p)), F.lit(False)).alias("agree")) for p in LEAVES])
    return pairs.select(key, "exposure_no", F.explode(cells).alias("c")).select(key, "exposure_no", "c.leaf", "c.agree").unionByName(odd)


def set_at(df: DataFrame, changes: DataFrame, key: str = "record_id") -> DataFrame:
    """Records with single measures replaced: ``changes(key, exposure_no, leaf, m)``.

    The changes of a record, at most one per exposure and leaf, are folded into a map and
    looked up while the exposures are rewritten in place; unchanged records are not shuffled
    into new shapes, only joined.
    """
    kind = f"struct<{','.join(('state:string', 'vals:array<double>', 'is_list:boolean'))}>"
    one = changes.groupBy(key, "exposure_no", "leaf").agg(F.min("m").alias("m"))
    per = one.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "exposure_no", "leaf"), F.col("m").cast(kind)))).alias("_m"))

    def rewrite(x: Column, i: Column) -> Column:
        def pick(path: str, old: Column) -> Column:
            k = F.concat(i.cast("string"), F.lit(f"|{path}"))
            return F.when(F.coalesce(F.map_contains_key("_m", k), F.lit(False)), F.element_at("_m", k)).otherwise(old)

        got = x  # fields are read from x, else every step would repeat those before it
        for b, names in BLOCKS.items():
            if b == "exposure":
                for n in names:
                    got = got.withField(n, pick(n, x[n]))
            else:
                inner = x[b]
                for n in names:
                    inner = inner.withField(n, pick(f"{b}.{n}", x[b][n]))
                got = got.withField(b, inner)
        return got

    return df.join(per, key, "left").withColumn("exposures", F.when(F.col("_m").isNull(), F.col("exposures")).otherwise(F.transform("exposures", lambda x, i: F.when(x.isNotNull(), rewrite(x, i))))).drop("_m")


def block_discipline(papers: DataFrame) -> DataFrame:
    """(record_id, exposure_no, rule): structural rules broken by an exposure.

    A block must have all of its measures or none; a measure with numbers has state "value",
    one without has not; a list of one is no list; a label of state must be known.
    """
    x = F.col("x")
    rules: list[tuple[str, Column]] = []
    for b, names in BLOCKS.items():
        if b in DOMAINS:
            has = [at(x, f"{b}.{n}").isNotNull() for n in names]
            some = reduce(lambda a, c: a | c, has)
            every = reduce(lambda a, c: a & c, has)
            rules.append((f"partial_block_{b}", some & ~every))
    leaves = F.array(*[at(x, p) for p in LEAVES])
    any_ = lambda f: F.exists(leaves, lambda m: F.coalesce(m.isNotNull() & f(m), F.lit(False)))
    n = lambda m: F.size(F.coalesce(m.vals, F.array().cast("array<double>")))
    rules += [
        ("value_without_number", any_(lambda m: (m.state == "value") & (n(m) == 0))),
        ("number_without_value", any_(lambda m: m.state.isin("not_reported", "na") & (n(m) > 0))),
        ("list_flag_wrong", any_(lambda m: m.is_list != (n(m) > 1))),
        ("unknown_state", any_(lambda m: ~m.state.isin("value", "not_reported", "na"))),
    ]
    found = F.array_compact(F.array(*[F.when(F.coalesce(t, F.lit(False)), F.lit(r)) for r, t in rules]))
    return exposures(papers, "record_id").select("record_id", "exposure_no", F.explode(found).alias("rule"))
