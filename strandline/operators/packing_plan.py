"""First fit decreasing over a histogram of sizes.

Items of one size are interchangeable, so the sequential algorithm runs on at most
``capacity`` sizes (larger items take batches of their own, in order) and gives, per size, which ranks go to which batches; items then take
their places by rank through a join. The result is that of the item-by-item algorithm with
ties in id order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.relational import numbered


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (size, lo, hi, first, per): ranks lo to hi-1 of a size go, ``per`` at a time, to the
    batches from ``first`` on. Sizes above the capacity get batches of their own."""
    runs: list[list[int]] = []  # [first batch, batches, free], in order of opening
    opened, out = 0, []
    for size in sorted(counts, reverse=True):
        n, rank = counts[size], 0
        after: list[list[int]] = []
        for first, m, free in runs:
            per = free // size
            if not n or not per:
                after.append([first, m, free])
                continue
            full = min(m, n // per)
            if full:
                out.append((size, rank, rank + full * per, first, per))
                after.append([first, full, free - per * size])
                rank, n = rank + full * per, n - full * per
            if full < m:
                if 0 < n < per:
                    out.append((size, rank, rank + n, first + full, n))
                    after.append([first + full, 1, free - n * size])
                    rank, n, full = rank + n, 0, full + 1
                if full < m:
                    after.append([first + full, m - full, free])
        runs = after
        if n:
            per = max(1, capacity // size)
            full, rest = divmod(n, per)
            if full:
                out.append((size, rank, rank + full * per, opened, per))
                runs.append([opened, full, max(0, capacity - per * size)])
            if rest:
                out.append((size, rank + full * per, rank + n, opened + full, rest))
                runs.append([opened + full, 1, max(0, capacity - rest * size)])
            opened += full + (rest > 0)
    return out


def first_fit(df: DataFrame, item: str, size: str, capacity: int) -> DataFrame:
    """(item, size, batch_no). Null sizes count as 0 and sizes below 1 as 1."""
    rows = df.select(item, F.greatest(F.lit(1), F.coalesce(F.col(size), F.lit(0))).alias("_n"))
    hist = rows.groupBy(F.least("_n", F.lit(capacity + 1)).alias("_n")).agg(F.count(F.lit(1)).alias("c")).collect()  # at most capacity + 1 rows
    counts = {r["_n"]: r["c"] for r in hist}
    alone = counts.pop(capacity + 1, 0)
    steps = plan(counts, capacity)
    before, seen = [], alone
    for n in sorted(counts, reverse=True):
        before.append((n, seen))
        seen += counts[n]
    spark = df.sparkSession
    places = spark.createDataFrame(steps, "_n long, lo long, hi long, first long, per long")
    ranks = numbered(rows, [F.desc("_n"), F.col(item)], "pos")
    got = ranks.join(spark.createDataFrame(before, "_n long, before long"), "_n").withColumn("rank", F.col("pos") - 1 - F.col("before")).join(places, "_n").where("rank >= lo and rank < hi")
    packed = got.select(item, F.col("_n").alias(size), (F.col("first") + alone + F.floor((F.col("rank") - F.col("lo")) / F.col("per"))).alias("batch_no"))
    return packed.unionByName(ranks.where(F.col("_n") > capacity).select(item, F.col("_n").alias(size), (F.col("pos") - 1).alias("batch_no")))
