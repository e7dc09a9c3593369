"""Progress as a stream: throughput by event time, sessions, the last state of each worker, new catalogue files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def throughput(events: DataFrame, size: str = "5 minutes", slide: str | None = None, late: str | None = None) -> DataFrame:
    """Events and value by window and type; `late` is the watermark that a stream needs."""
    rows = events.withWatermark("ts", late) if late else events
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return rows.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """Runs of a worker's events without a gap: start, end of the last event plus the gap, number."""
    rows = events.withWatermark("ts", late) if late else events
    return rows.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def latest_states(events: DataFrame) -> DataFrame:
    """The last event of each worker; as a stream in update mode its state holds one row a worker."""
    return events.groupBy("user_id").agg(F.max_by(F.struct("ts", "event_id", "event_type", "value"), F.struct("ts", "event_id")).alias("last")).select("user_id", "last.*")


def follow_catalogues(spark: SparkSession, folder: str, schema: str, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand the rows of catalogue files that are new since the last call to handle(rows, batch), each file once."""
    rows = spark.readStream.schema(schema).parquet(folder)
    rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
