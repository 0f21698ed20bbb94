"""Streaming forms of the incremental operators.

Event time is cast to TIMESTAMP (watermarks refuse zoneless columns). ``history`` keeps, per
key, the state last seen and how often it changed; events of one trigger are put in time
order before they are folded in. Results equal the batch operators over the same rows when
every key's events arrive in order across triggers.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import IntegerType, StructField, StructType

from strandline.session import forget_at_end, shared_dir

CURRENT = "user_id long, event_type string, n_replaced long"


def source(spark: SparkSession, base: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream."""
    schema = spark.read.parquet(f"{base}/{name}.parquet").schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path = f"{base}/{name}.parquet"
    return reader.parquet(path if os.path.isdir(path) else f"{base}/{name}*.parquet")


def _fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
    last, n = state.get if state.exists else (None, 0)
    for kind in rows["event_type"]:
        if last is not None and kind != last:
            n += 1
        last = kind
    state.update((last, n))
    yield pd.DataFrame({"user_id": [key[0]], "event_type": [last], "n_replaced": [n]})


def history(events: DataFrame) -> DataFrame:
    """(user_id, event_type, n_replaced) in update mode: the current state of every key."""
    rows = events.where("user_id is not null and event_type is not null").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
    return rows.groupBy("user_id").applyInPandasWithState(_fold, CURRENT, "event_type string, n_replaced long", "update", "NoTimeout")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, start, end, n): session windows; in append mode those that the watermark has closed,
    in complete mode all of them, open ones as they stand."""
    rows = events.select("user_id", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", late)
    got = rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return got.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen(events: DataFrame, key: str, late: str = "40 days") -> DataFrame:
    """The first event of every key: an accumulating harvest."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def drain(stream: DataFrame, mode: str) -> DataFrame:
    """Runs a stream over what is there now and returns the rows written, with their trigger.

    State and output lie in the shared folder, so a lost executor resumes from there.
    """
    spark = stream.sparkSession
    at = os.path.join(shared_dir(spark), f"stream-{uuid.uuid4().hex}")
    kind = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("append").parquet(f"{at}/out")

    q = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    forget_at_end(spark, at)
    return spark.read.schema(StructType([*kind.fields, StructField("_batch", IntegerType())])).parquet(f"{at}/out")
