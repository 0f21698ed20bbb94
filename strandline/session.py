"""Session helpers: table access, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``base``."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share, from ``spark.checkpoint.dir``.

    Where the setting is absent (tests, local mode) a temporary folder is made and
    remembered in the session, which is right only for a single machine.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.strandline.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="strandline-")
        spark.conf.set("spark.strandline.dir", at)
    return at


def forget_at_end(spark: SparkSession, path: str) -> None:
    """Has the file system delete ``path`` when the application ends."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def cut(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Ends the lineage: a lost executor costs a re-read, not a recomputation, and
    non-deterministic columns (partition numbers) are frozen. Evaluates ``df`` once. The
    folder is deleted when the application ends.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"cut-{uuid.uuid4().hex}")
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    forget_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for ``df`` if it has at most ``rows`` rows, else no hint.

    The check reads at most ``rows + 1`` rows, so it costs little on a large table.
    """
    n = df.limit(rows + 1).agg(F.count(F.lit(1))).first()[0]
    return F.broadcast(df) if n <= rows else df
