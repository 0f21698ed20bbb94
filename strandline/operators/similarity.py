"""Exact set-similarity join of short token sets by combinations of hashed parts.

Meant for titles and name lists. Sets are reduced to classes of equal sets first; links are
between classes, and membership is returned beside them, so a third of all rows being copies
costs one class. Sets that differ in at most d tokens, put into d + 2 parts by the tokens'
hashes, have two parts in common, so each pair of parts is a signature: about half a title,
which few others hold however frequent its words are. Pairs that share one are tested against
parity bits before they are written anywhere, so what is written is nearly free of false pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions import text as tx
from strandline.session import cut, shuffle_partitions, small_enough

#: Above so many differing tokens single parts are signatures: their pairs would be too many.
PAIRED = 6
#: Sets in links up to which their hashes are broadcast, some 30 MB; more are joined by shuffle.
SENT = 1_000_000


def differences(n: int, t: float) -> list[int]:
    """Numbers of differing tokens, 1 or more, that Jaccard similarity ``t`` allows a set of
    size n and its partners of each size."""
    most = {math.floor((1 - t) / (1 + t) * (n + m) + 1e-9) for m in range(math.ceil(t * n - 1e-9), math.floor(n / t + 1e-9) + 1)}
    return sorted(most - {0})


def part_signatures(hashes: np.ndarray, size: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """(signature, position of the set) of sets whose tokens' hashes stand one after the other."""
    U = np.uint64  # noqa: N806
    own = np.repeat(np.arange(len(size)), size)
    by_size = {n: differences(n, t) for n in np.unique(size).tolist()}
    sigs, sets = [np.zeros(0, U)], [np.zeros(0, np.int64)]
    for d in sorted({d for ds in by_size.values() for d in ds}):
        use = np.isin(size, [n for n, ds in by_size.items() if d in ds])
        who = np.flatnonzero(use)
        at = (np.cumsum(use) - 1)[own[use[own]]]
        token = hashes[use[own]]
        together = 2 if d <= PAIRED else 1
        parts = d + together
        total = np.zeros((len(who), parts), U)
        np.add.at(total, (at, ((token >> U(32)) % U(parts)).astype(np.int64)), token)
        for k, some in enumerate(itertools.combinations(range(parts), together)):
            sig = np.full(len(who), d * 4096 + k, U)
            for j in some:
                sig = (sig ^ total[:, j]) * U(0x9E3779B97F4A7C15)
                sig ^= sig >> U(29)
            sigs.append(sig)
            sets.append(who)
    return np.concatenate(sigs), np.concatenate(sets)


def set_join(df: DataFrame, key: str, tokens: Column, t: float) -> tuple[DataFrame, DataFrame]:
    """(members, links): members(key, class_id), links(a, b, similarity) of different classes
    with Jaccard similarity ``t`` or more, a < b. Empty and null sets are in no class."""
    rows = cut(df.select(key, F.array_sort(F.array_distinct(tokens)).alias("s")).where("size(s) > 0"))
    for salt in itertools.count():  # a set is named by one hash; another salt, if a second hash shows that two sets share it
        rows = rows.withColumn("h", F.xxhash64(F.lit(salt), "s"))
        other = F.xxhash64(F.lit("other"), "s")
        classes = cut(rows.groupBy("h").agg(F.min(key).alias("class_id"), (F.min(other) != F.max(other)).alias("mixed")))
        if classes.where("mixed").isEmpty():
            break
    classes = classes.select("h", "class_id")
    joined = rows.join(classes, "h").select(key, "class_id")
    loose = t - 2e-9  # as the comparison below

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, hashes = b.column(0).to_numpy(), b.column(1).flatten().to_numpy().view(np.uint64)
            size = np.diff(b.column(1).offsets.to_numpy())
            once = np.zeros(len(h), bool)
            once[np.unique(h, return_index=True)[1]] = True  # copies once
            hashes, h, size = hashes[np.repeat(once, size)], h[once], size[once]
            flips = np.bincount(np.repeat(np.arange(len(h)), size) * 64 + (hashes >> np.uint64(26) & np.uint64(63)).astype(np.int64), minlength=len(h) * 64)
            bits = np.packbits((flips & 1).astype(np.uint8).reshape(-1, 64), axis=1).view(np.int64).ravel()
            sig, who = part_signatures(hashes, size, loose)
            yield pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(h[who]), pa.array(size[who].astype(np.int32)), pa.array(bits[who])], ["sig", "h", "n", "bits"])

    sig = rows.select("h", F.transform("s", lambda x: F.xxhash64(x)).alias("v")).mapInArrow(emit, "sig long, h long, n int, bits long")
    x, y = sig.alias("x"), sig.alias("y")
    near = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.h") < F.col("y.h")) & (F.least("x.n", "y.n") >= loose * F.greatest("x.n", "y.n") - 1e-9)
    near &= F.bit_count(F.col("x.bits").bitwiseXOR(F.col("y.bits"))) <= (1 - loose) / (1 + loose) * (F.col("x.n") + F.col("y.n")) + 1e-9
    maybe = cut(x.join(y, near).select(F.col("x.h").alias("a"), F.col("y.h").alias("b")).distinct())
    wanted = small_enough(cut(maybe.select(F.explode(F.array("a", "b")).alias("h")).distinct()), SENT)
    named = classes.join(wanted, "h", "left_semi")
    s = rows.join(wanted, "h", "left_semi").groupBy("h").agg(F.first("s").alias("s")).join(named, "h")
    side = lambda k: s.select(F.col("h").alias(k), F.col("class_id").alias(f"c{k}"), F.col("s").alias(f"s{k}"))
    both = maybe.join(side("a"), "a").join(side("b"), "b").where("ca <> cb")
    same = F.size(F.array_intersect("sa", "sb"))
    sim = same / (F.size("sa") + F.size("sb") - same)
    links = both.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), sim.alias("similarity"))
    return joined, links.where(F.col("similarity") >= t - 1e-9)


def letter_counts(c: str) -> Column:
    """How often each of a to z and 0 to 9 occurs."""
    return F.array(*[F.length(c) - F.length(F.replace(F.col(c), F.lit(x))) for x in "abcdefghijklmnopqrstuvwxyz0123456789"])


def author_pairs(df: DataFrame, key: str, author: str, title: str, year: str, span: int = 3, least: float = 0.85, share: int = 200) -> DataFrame:
    """(a, b, rows_a, rows_b, ratio): titles of one author, years within ``span``, of sequence
    ratio ``least`` or more.

    Rows of equal author, year and title are one class, named by its smallest key, with its
    number of rows; a class of several rows is also paired with itself. ``title`` holds a to z
    and 0 to 9 only; null years count as 0. Rows without an author or title pair with nothing.
    The titles of one author and year are compared in shares of about ``share``; common letters
    bound the ratio natively.
    """
    rows = df.select(key, F.col(author).alias("w"), F.coalesce(year, F.lit(0)).alias("y"), F.col(title).alias("t")).where("w <> '' and t <> ''")
    c = cut(rows.groupBy("w", "y", "t").agg(F.min(key).alias("id"), F.count(F.lit(1)).alias("rows")).withColumn("l", letter_counts("t")))
    shares = c.groupBy("w", "y").agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("m"))
    many = shuffle_partitions(df.sparkSession)  # stated, as few bytes make many pairs here
    y = c.join(shares, ["w", "y"]).withColumn("n", F.pmod(F.xxhash64("t"), F.col("m")).cast("int")).drop("m").withColumnsRenamed({"id": "jd", "rows": "rows_j", "t": "u", "l": "k", "y": "z"})
    x = c.withColumn("z", F.explode(F.sequence(F.col("y"), F.col("y") + span))).join(shares.withColumnRenamed("y", "z"), ["w", "z"]).withColumn("n", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).drop("m")
    common = F.aggregate(F.zip_with("l", "k", lambda p, q: F.least(p, q)), F.lit(0), lambda s, v: s + v)
    on = ["w", "z", "n"]
    near = x.repartition(many, *on).join(y.repartition(many, *on), on).where("y < z or id < jd or (id = jd and rows > 1)")
    near = near.where(2 * F.least(F.length("t"), F.length("u")) >= least * (F.length("t") + F.length("u")) - 1e-9).where(2 * common >= least * (F.length("t") + F.length("u")) - 1e-9)
    flip = F.col("id") > F.col("jd")
    pick = lambda p, q: F.when(flip, F.col(q)).otherwise(F.col(p))
    near = near.select(pick("id", "jd").alias("a"), pick("jd", "id").alias("b"), pick("rows", "rows_j").alias("rows_a"), pick("rows_j", "rows").alias("rows_b"), pick("t", "u").alias("t"), pick("u", "t").alias("u"))
    return near.repartition(many, "a", "b").withColumn("ratio", tx.similarity_ratio(F.col("t"), F.col("u"))).where(F.col("ratio") >= least).drop("t", "u")


def link_counts(members: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """(key, class_id, n_links): one row per member with its class and the class's links."""
    n = links.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    return members.join(n, "class_id", "left").select(key, "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def overlap_coefficient(a: Column, b: Column) -> Column:
    """Common elements by the smaller set; null if either is empty."""
    return F.try_divide(F.size(F.array_intersect(a, b)), F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b))))


def bag_cosine(a: Column, b: Column) -> Column:
    """Cosine of two bags of words given as arrays with repeats."""
    words = F.array_union(a, b)
    count = lambda bag, w: F.size(F.filter(bag, lambda v: v == w)).cast("double")
    dot = F.aggregate(words, F.lit(0.0), lambda s, w: s + count(a, w) * count(b, w))
    norm = lambda bag: F.sqrt(F.aggregate(F.array_distinct(bag), F.lit(0.0), lambda s, w: s + count(bag, w) * count(bag, w)))
    return F.try_divide(dot, norm(a) * norm(b))


def nearest(df: DataFrame, key: str, vector: str, queries: Column, block: int = 4096, least_norm: float = 1e-12) -> DataFrame:
    """(query, neighbour, cosine): the nearest other row of every row chosen by ``queries``.

    The chosen rows are taken in blocks of ``block`` vectors. Per block, one pass over all rows
    multiplies matrices and keeps the best per partition, so what is sent is one block and what
    comes back is one candidate per query and partition. Null, empty and zero vectors take part
    in nothing; ties go to the smaller key.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).alias("k"), F.col(vector).cast("array<double>").alias("v")).where("k is not null and v is not null and size(v) > 0")
    chosen = cut(rows.where(queries))
    total = chosen.count()
    kind = df.schema[key].dataType.simpleString()
    schema = f"query {kind}, neighbour {kind}, cosine double"
    out = None
    order = chosen.orderBy("k")
    for k in range(math.ceil(total / block)):
        part = order.offset(k * block).limit(block).collect()  # one block
        q = np.array([r["v"] for r in part])
        norm = np.linalg.norm(q, axis=1)
        keep = norm > least_norm
        sent = spark.sparkContext.broadcast((np.array([r["k"] for r in part])[keep], q[keep] / norm[keep, None]))

        def best(frames, sent=sent):
            ids, mat = sent.value
            top, at = np.full(len(ids), -np.inf), np.zeros(len(ids), ids.dtype)
            for f in frames:
                m = np.stack(f["v"].to_numpy())
                n = np.linalg.norm(m, axis=1)
                m, own = m[n > least_norm] / n[n > least_norm, None], f["k"].to_numpy()[n > least_norm]
                order = np.argsort(own, kind="stable")
                m, own = m[order], own[order]
                if not len(own):
                    continue
                s = np.round(mat @ m.T, 9)
                s[ids[:, None] == own[None, :]] = -np.inf
                j = s.argmax(1)
                v = s[np.arange(len(ids)), j]
                better = (v > top) | ((v == top) & (own[j] < at))
                top, at = np.where(better, v, top), np.where(better, own[j], at)
            ok = np.isfinite(top)
            yield pd.DataFrame({"query": ids[ok], "neighbour": at[ok], "cosine": top[ok]})

        got = rows.mapInPandas(best, schema).groupBy("query").agg(F.max(F.struct("cosine", (-F.col("neighbour")).alias("n"))).alias("m"))
        got = got.select("query", (-F.col("m.n")).alias("neighbour"), F.col("m.cosine").alias("cosine"))
        out = got if out is None else out.unionByName(got)
    return out if out is not None else spark.createDataFrame([], schema)
