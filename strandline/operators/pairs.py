"""Joins of records that resemble each other: shared names and wording, title prefixes, mentions.

Candidates come from equi-joins on what both sides must share; hot values are split into shares,
so no task holds all rows of one name. Null and empty names, titles and phrases match nothing.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from strandline.functions import text as tx
from strandline.session import cut, shuffle_partitions


@F.pandas_udf(DoubleType())
def word_cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    """Cosine of two bags of words, arrays with repeats; 0 if either is empty."""
    out = []
    for x, y in zip(a, b):
        p, q = Counter(x if x is not None else ()), Counter(y if y is not None else ())
        dot = sum(n * q[w] for w, n in p.items() if w in q)
        size = (sum(n * n for n in p.values()) * sum(n * n for n in q.values())) ** 0.5
        out.append(dot / size if size else 0.0)
    return pd.Series(out, dtype="float64")


def resembling(left: DataFrame, right: DataFrame, overlap: float, cosine: float, share: int = 500) -> DataFrame:
    """(a, b, overlap, cosine): pairs of ``left`` and ``right`` (id, names, words), a other than b, whose
    names overlap by ``overlap`` of the smaller set and whose words have that ``cosine``.

    A pair shares a name, so pairs are counted per shared name; the right side of a name is split
    into shares of about ``share`` rows. The overlap is tested before any word is looked at.
    """
    many = shuffle_partitions(left.sparkSession)
    side = lambda df, k, n: df.select(F.col("id").alias(k), F.array_distinct(F.filter("names", lambda x: x != "")).alias("_n")).where("size(_n) > 0").select(k, F.size("_n").alias(n), F.explode("_n").alias("w"))
    x, y = side(left, "a", "na"), cut(side(right, "b", "nb"))
    shares = y.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("m"))
    x = x.join(shares, "w").withColumn("s", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).drop("m")
    y = y.join(shares, "w").withColumn("s", F.pmod(F.xxhash64("b"), F.col("m")).cast("int")).drop("m")
    both = x.repartition(many, "w", "s").join(y.repartition(many, "w", "s"), ["w", "s"]).where("a <> b")
    near = both.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    near = near.withColumn("overlap", F.col("c") / F.least("na", "nb")).where(F.col("overlap") >= overlap - 1e-9).select("a", "b", "overlap")
    words = lambda df, k, w: df.select(F.col("id").alias(k), F.col("words").alias(w))
    got = near.join(words(left, "a", "wa"), "a").join(words(right, "b", "wb"), "b")
    return got.select("a", "b", "overlap", word_cosine("wa", "wb").alias("cosine")).where(F.col("cosine") >= cosine - 1e-9)


def first_tier(pairs: DataFrame, tiers: list[tuple[str, float, float]], order: str = "b") -> DataFrame:
    """(a, tier, b): per ``a`` the first pair of the first tier (name, overlap, cosine) that any of its
    pairs reaches; pairs that reach none are left out."""
    no = F.lit(None).cast("int")
    for i in range(len(tiers) - 1, -1, -1):
        no = F.when((F.col("overlap") >= tiers[i][1] - 1e-9) & (F.col("cosine") >= tiers[i][2] - 1e-9), i).otherwise(no)
    best = pairs.withColumn("_t", no).where("_t is not null").groupBy("a").agg(F.min(F.struct("_t", F.col(order).alias("_o"), "b")).alias("m"))
    names = F.array(*[F.lit(n) for n, _, _ in tiers])
    return best.select("a", F.get(names, F.col("m._t")).alias("tier"), F.col("m.b").alias("b"))


def prefixed_titles(df: DataFrame, key: str, journal: Column, title: Column, identity: Column, least: int = 30) -> DataFrame:
    """(a, b): entries of one journal with other identities, of which one title's key is the beginning
    of the other's, ``least`` characters at least; a has the shorter title (equal ones: a < b).

    Rows of equal journal, title and identity are one class, named by its smallest key. The join
    is on the first ``least`` characters.
    """
    rows = df.select(F.col(key).alias("id"), journal.alias("j"), tx.title_key(title).alias("t"), identity.alias("i")).where(f"j is not null and i is not null and length(t) >= {least}")
    one = cut(rows.groupBy("j", "t", "i").agg(F.min("id").alias("id")).withColumn("p", F.substring("t", 1, least)))
    y = one.select("j", "p", F.col("t").alias("u"), F.col("i").alias("k"), F.col("id").alias("b"))
    hit = one.join(y, ["j", "p"]).where((F.col("i") != F.col("k")) & F.startswith("u", F.col("t")) & ((F.length("t") < F.length("u")) | (F.col("id") < F.col("b"))))
    return hit.select(F.col("id").alias("a"), "b").distinct()


def mentions(texts: DataFrame, key: str, body: str, phrases: DataFrame) -> DataFrame:
    """(id, n_texts): how many texts mention any phrase of ``phrases(id, phrase)``.

    Phrases and texts are lower-cased runs of letters and digits; a phrase of two characters or
    more is mentioned where its words stand in a row. Texts and phrases meet at the phrase's word
    that is in fewest texts; longer phrases are then looked for in the texts that have that word.
    Ids without a mention come out with 0.
    """
    norm = lambda c: F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))
    p = cut(phrases.select("id", norm(F.col("phrase")).alias("g")).where("length(g) > 1").distinct())
    t = cut(texts.where(F.col(body).isNotNull()).select(F.col(key).alias("k"), norm(F.col(body)).alias("t")))
    used = p.select("g").distinct().select("g", F.explode(F.array_distinct(F.split("g", " "))).alias("w"))
    words = t.select("k", F.explode(F.split("t", " ")).alias("w")).join(used.select("w").distinct(), "w", "left_semi").distinct()
    words = cut(words)
    often = words.groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    keyed = used.join(often, "w").groupBy("g").agg(F.min(F.struct("n", "w")).alias("m"), F.count(F.lit(1)).alias("c"))
    whole = keyed.join(used.groupBy("g").agg(F.count(F.lit(1)).alias("all")), "g").where("c = all").select("g", F.col("m.w").alias("w"))  # every word is in some text
    maybe = words.join(whole, "w").select("k", "g")
    long = maybe.where(F.contains("g", F.lit(" "))).join(t, "k").where(F.contains(F.concat(F.lit(" "), "t", F.lit(" ")), F.concat(F.lit(" "), "g", F.lit(" ")))).select("k", "g")
    hits = maybe.where(~F.contains("g", F.lit(" "))).unionByName(long).join(p, "g").select("id", "k").distinct().groupBy("id").agg(F.count(F.lit(1)).alias("n_texts"))
    return phrases.select("id").distinct().join(hits, "id", "left").select("id", F.coalesce("n_texts", F.lit(0)).alias("n_texts"))
