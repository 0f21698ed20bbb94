"""Writers. A plan is a DataFrame; these functions alone act on it.

None overwrites a path that its input reads; versions are written beside each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.relational import numbered


def sorted_json(df: DataFrame, path: str, *keys: str) -> None:
    """JSON lines in key order with the fields of each line in name order."""
    line = F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})
    df.orderBy(*keys).select(line.alias("value")).write.mode("overwrite").text(path)


def fan_out(df: DataFrame, path: str, key: str) -> None:
    """One folder per key; older folders are removed. Rows of a key are brought together first,
    so that each folder gets few files."""
    df.repartition(F.col(key)).write.mode("overwrite").partitionBy(key).json(path)


def batches(df: DataFrame, path: str, size: int, *order: str) -> None:
    """Fixed-size batches in order, one folder per batch."""
    got = numbered(df, [F.col(c) for c in order]).withColumn("batch_no", F.floor((F.col("pos") - 1) / size))
    got.repartition("batch_no").sortWithinPartitions("batch_no", "pos").write.mode("overwrite").partitionBy("batch_no").json(path)


def ranked_csv(df: DataFrame, path: str, link: str, *order: Column) -> None:
    """CSV with rank, batch of 100 and a spreadsheet link."""
    got = numbered(df, list(order), "rank").withColumn("batch", F.ceil(F.col("rank") / 100))
    formula = F.concat(F.lit('=HYPERLINK("'), F.replace(F.col(link), F.lit('"'), F.lit('""')), F.lit('")'))
    got.withColumn("open", formula).orderBy("rank").write.mode("overwrite").option("header", True).csv(path)


def promote(df: DataFrame, violations: DataFrame, key: str, path: str) -> None:
    """Writes only the rows without a violation."""
    df.join(violations.select(key).distinct(), key, "left_anti").write.mode("overwrite").parquet(path)


def all_or_nothing(df: DataFrame, ok: Column, path: str) -> bool:
    """Writes all rows if every row is ``ok`` (null counts as not); else nothing."""
    bad = df.where(~F.coalesce(ok, F.lit(False))).limit(1).count()
    if not bad:
        df.write.mode("overwrite").parquet(path)
    return not bad


def version(df: DataFrame, base: str, name: str) -> None:
    """A new snapshot in folder v=<name>; an existing one is an error."""
    df.write.mode("errorifexists").parquet(f"{base}/v={name}")


def bundle(frames: dict[str, DataFrame], base: str) -> None:
    """Several outputs of one compilation, each in its folder."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")


def safe_to_delete(live: int, orphans: int, least: int = 20, share: float = 0.2) -> bool:
    """The brake before a mass deletion."""
    return orphans <= max(least, live * share)


def next_version(now: tuple[int, int], released: str | None) -> str:
    """Calendar version year.month.n: the next number within the month, else 0."""
    head = f"{now[0]}.{now[1]:02d}"
    if released and released.startswith(head + "."):
        return f"{head}.{int(released.rsplit('.', 1)[1]) + 1}"
    return f"{head}.0"
