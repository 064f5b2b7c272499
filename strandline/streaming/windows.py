"""Event-time windows and read clusters over streams, with watermarks; the same functions run on batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _timed(events: DataFrame) -> DataFrame:
    """ts as an instant: watermarks need one, and files may hold local times."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """window_start, event_type, n, total: counts of tumbling (or sliding) windows; rows later than `late` are dropped by
    a stream and kept by a batch."""
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    grouped = _timed(events).withWatermark("ts", late).groupBy(window.alias("w"), "event_type")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """user_id, session_start, session_end, n: runs of a user's events with less than gap between them."""
    grouped = _timed(events).withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w"))
    return grouped.agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def deduplicated(events: DataFrame, key: str, late: str = "2 hours") -> DataFrame:
    return _timed(events).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def read_events(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A stream over the Parquet files of a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def to_table(stream: DataFrame, name: str, checkpoint: str, mode: str = "append"):
    """Runs the stream over what is there now, into an in-memory table; exactly once across restarts by its checkpoint."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
