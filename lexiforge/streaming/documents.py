"""The row-local operators over streams of files, and windowed counts of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import documents as D


def landing(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def profiles(stream: DataFrame) -> DataFrame:
    """Counts and routes of documents as they arrive; no state."""
    return D.profile(stream)


def each_batch(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Applies a batch operator to every micro-batch.

    A batch's rows go to a folder of its number, written over if the batch is
    run again, so each batch counts once.
    """

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "30 minutes") -> DataFrame:
    """Events and their value by window and type; rows later than ``late`` are dropped with their window's state."""
    span = F.window("ts", window)
    out = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(span.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "value")
