"""Resumable ingest: new files are taken once, in whole, by a checkpointed stream that ends when it has caught up."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery


def new_files(spark: SparkSession, folder: str, schema: T.StructType, form: str = "parquet", files_a_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).format(form).load(folder)


def catch_up(stream: DataFrame, target: str, checkpoint: str, by: Sequence[str] = ()) -> StreamingQuery:
    """Appends everything new to a Parquet table, exactly once, and stops."""
    writer = stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    return (writer.partitionBy(*by) if by else writer).start()


def each_batch(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs a step on each batch; the step sees the batch's number, so that it can be idempotent."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, at: str, by: Sequence[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by event-time window; rows later than the watermark are left out of a stream, and state behind it is dropped."""
    return events.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def once_per_key(events: DataFrame, at: str, key: Sequence[str], late: str = "2 hours") -> DataFrame:
    """Drops repeats that arrive within the watermark."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(list(key))
