"""Identity of documents: resolver order, links between versions, repaired keys, inherited quotes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strandline.functions import measures as ms, text as tx
from strandline.operators.facts import unpivot
from strandline.session import cut, shuffle_partitions


def by_priority(df: DataFrame, item: str, resolvers: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(item, key, resolver): the key of the first resolver that has one for the item.

    Each resolver is a frame (item, key); of several keys of one resolver the smallest counts.
    Items without a key come out with resolver "unresolved".
    """
    got = df.select(item).distinct()
    parts = [r.select(item, F.lit(i).alias("p"), F.lit(n).alias("resolver"), "key") for i, (n, r) in enumerate(resolvers)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    best = every.where("key is not null").groupBy(item).agg(F.min(F.struct("p", "key", "resolver")).alias("m"))
    return got.join(best, item, "left").select(item, F.col("m.key").alias("key"), F.coalesce("m.resolver", F.lit("unresolved")).alias("resolver"))


def first_verified(cands: DataFrame, item: str, verified: Column, pos: str) -> DataFrame:
    """The first verified candidate of an item, else its first candidate at all."""
    rest = [c for c in cands.columns if c not in (item, pos)]
    order = F.struct((~F.coalesce(verified, F.lit(False))).alias("late"), F.col(pos), *rest)
    return cands.groupBy(item).agg(F.min(order).alias("m")).select(item, F.col("m.late").alias("unverified"), f"m.{pos}", *[f"m.{c}" for c in rest])


def best_candidate(cands: DataFrame, item: str, score: str, year: str, want: str, pages: str) -> DataFrame:
    """The candidate of the best score, then exact year, then more than one page, then nearest
    year; a max-aggregate of a tuple."""
    rest = [c for c in cands.columns if c not in (item, score)]
    tup = F.struct(
        F.round(score, 3).alias("s"), F.coalesce(F.col(year) == F.col(want), F.lit(False)).alias("y"), F.coalesce(F.col(pages) > 1, F.lit(False)).alias("p"),
        (-F.coalesce(F.abs(F.col(year) - F.col(want)), F.lit(9999))).alias("d"), *rest,
    )
    return cands.groupBy(item).agg(F.max(tup).alias("m")).select(item, F.col("m.s").alias(score), *[f"m.{c}" for c in rest])


def near_signatures(c: str, least: float, known: bool) -> Column:
    """Hashes, at least one of which two strings of sequence ratio ``least`` or more share.

    A ratio of ``least`` leaves at most d = (1 - least) * (both lengths) characters unmatched.
    A known string is cut into one piece more than that, so one piece is whole in the other
    string; there, for every length the known string may have, the piece is taken at every place
    to which unmatched characters can shift it.
    """
    n, gap, widest = f"length({c})", repr(1 - least), repr((2 - least) / least)
    pieces = f"cast(floor({gap} * (m + floor(m * {widest} + 1e-9)) + 1e-9) as int) + 1"
    start = lambda i: f"cast(floor(({i}) * m / ({pieces})) as int)"
    left = f"floor({gap} * (m + {n}) + 1e-9)"
    lengths, shifts = f"array({n})", "array(0)"
    if not known:
        lengths = f"filter(sequence(cast(floor({n} / {widest}) as int), cast(floor({n} * {widest} + 1e-9) as int)), m -> m > 0 and {left} >= abs({n} - m))"
        shifts = f"sequence(-cast(floor(({left} - {n} + m) / 2) as int), cast(floor(({left} + {n} - m) / 2) as int))"
    inside = f"filter({shifts}, s -> {start('i')} + s >= 0 and {start('i + 1')} + s <= {n})"
    taken = f"transform({inside}, s -> xxhash64(m, i, substring({c}, {start('i')} + s + 1, {start('i + 1')} - {start('i')})))"
    return F.expr(f"array_distinct(flatten(transform({lengths}, m -> flatten(transform(sequence(0, {pieces} - 1), i -> {taken})))))")


def odd_grams(c: str, n: int) -> Column:
    """Bitmap of the n-grams that occur an odd number of times, hashed to 64 bits. One character
    more or less flips at most one bit for n = 1, three for n = 2."""
    grams = f"transform(sequence(1, greatest(1, length({c}) - {n - 1})), i -> substring({c}, i, {n}))"
    return F.expr(f"aggregate({grams}, 0L, (s, g) -> s ^ shiftleft(1L, cast(pmod(xxhash64(g), 64) as int)))")


def repaired(wrong: DataFrame, known: DataFrame, key: str, block: Column | None = None, least: float = 0.95, share: int = 256) -> DataFrame:
    """(key, repaired, ratio): unknown keys with exactly one known key that is nearly equal.

    Every unknown key is compared with every known key that is not itself among the given
    ones: candidates share a signature, which no pair of ratio ``least`` lacks; bitmaps and edit
    distance bound them natively, sequence ratio decides. Two candidates repair nothing. Known
    keys of one signature (journals have long common beginnings) are compared in shares of about
    ``share``. A ``block`` (an expression over ``key``) restricts the comparison to keys of the
    same value.
    """
    given, held = wrong.select(key).where(F.length(key) > 0).distinct(), known.select(key).where(F.length(key) > 0).distinct()
    many = shuffle_partitions(wrong.sparkSession)  # stated, as few bytes make many pairs here
    bits = lambda df: cut(df.withColumns({"_1": odd_grams(key, 1), "_2": odd_grams(key, 2)})).repartition(many, key)
    a, b = bits(given.join(held, key, "left_anti")), bits(held.join(given, key, "left_anti"))
    on = ["_s", "_n"]
    if block is not None:
        a, b, on = a.withColumn("_b", block).where("_b <> ''"), b.withColumn("_b", block), [*on, "_b"]
    a = a.withColumn("_s", F.explode(near_signatures(key, least, False)))
    b = cut(b.withColumn("_s", F.explode(near_signatures(key, least, True))).withColumnsRenamed({key: "_k", "_1": "_k1", "_2": "_k2"}))
    shares = b.groupBy("_s").agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("_m"))
    a = a.join(shares, "_s").withColumn("_n", F.explode(F.sequence(F.lit(0), F.col("_m") - 1))).drop("_m").repartition(many, *on)
    b = b.join(shares, "_s").withColumn("_n", F.pmod(F.xxhash64("_k"), F.col("_m")).cast("int")).drop("_m").repartition(many, *on)
    far = F.floor((1 - least) * (F.length(key) + F.length("_k")) + 1e-9).cast("int")
    flips = lambda n: F.bit_count(F.col(f"_{n}").bitwiseXOR(F.col(f"_k{n}")))
    near = a.join(b, on).where(F.when((flips(2) <= 3 * far) & (flips(1) <= far), F.levenshtein(F.col(key), F.col("_k")) <= far))  # in this order
    scored = near.select(key, "_k").distinct().repartition(many, key, "_k").withColumn("ratio", tx.similarity_ratio(F.col("_k"), F.col(key))).where(F.col("ratio") >= least)
    got = scored.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_k", "ratio")).alias("m")).where("n = 1")
    return got.select(key, F.col("m._k").alias("repaired"), F.round("m.ratio", 6).alias("ratio"))


def version_links(papers: DataFrame, edges: DataFrame, key: str = "key") -> DataFrame:
    """(src, dst, status): declared relations; "merge" if both halves are held, "missing" if the
    other is not, "self" for loops."""
    held = papers.where(F.col(key).isNotNull()).select(F.col(key).alias("dst"), F.lit(True).alias("_h")).distinct()
    got = edges.where("src is not null and dst is not null").distinct().join(held, "dst", "left")
    return got.select("src", "dst", F.when(F.col("src") == F.col("dst"), "self").when(F.col("_h"), "merge").otherwise("missing").alias("status"))


def quote_origin(papers: DataFrame) -> DataFrame:
    """(record_id, exposure_no, leaf, origin): where the quotation of each reported measure comes
    from: its own, the first sibling exposure with the same values that has one, or none.

    The first quoted sibling per (record, leaf, values) is a window over one record's rows.
    """
    quotes = papers.select("record_id", F.explode("provenance.source_quotes").alias("path", "quote")).where("quote is not null").groupBy("record_id", "path").agg(F.min("quote").alias("quote"))
    cells = unpivot(papers, "record_id").withColumn("v", F.array_sort(ms.numbers(F.col("m")))).where("size(v) > 0").join(quotes, ["record_id", "path"], "left")
    same = Window.partitionBy("record_id", "leaf", "v")
    first = F.min(F.when(F.col("quote").isNotNull(), F.col("exposure_no"))).over(same)
    origin = F.when(F.col("quote").isNotNull(), "own").when(first.isNotNull(), "inherited").otherwise("none")
    return cells.select("record_id", "exposure_no", "leaf", origin.alias("origin"))


def updated_flags(flags: Column, stale: Column, new: Column) -> Column:
    """Flags without the stale ones and with the new ones, distinct and sorted; nulls as empty."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.concat(F.array_except(F.coalesce(flags, none), F.coalesce(stale, none)), F.coalesce(new, none))))


def seeds(sources: Sequence[DataFrame], key: str, order: str) -> DataFrame:
    """(key, source_no, pos): keys of several ordered sources, each at its first place."""
    every = None
    for i, s in enumerate(sources):
        part = s.select(key, F.lit(i).alias("source_no"), F.col(order).alias("pos"))
        every = part if every is None else every.unionByName(part)
    return every.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("source_no", "pos")).alias("m")).select(key, "m.source_no", "m.pos")
