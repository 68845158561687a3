"""Streams of events: windows by time, sessions, repeated events. Each works on a batch table as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stamped(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Timestamps without a zone, read as UTC: only zoned ones can carry a watermark. The session's zone must be UTC."""
    return events.withColumn(ts, F.col(ts).cast("timestamp"))


def read(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(path)


def _late(events: DataFrame, ts: str, delay: str) -> DataFrame:
    return events.withWatermark(ts, delay) if events.isStreaming else events


def tumbling(events: DataFrame, size: str = "1 day", delay: str = "1 day", by: list[str] | None = None, ts: str = "ts") -> DataFrame:
    return sliding(events, size, size, delay, by, ts)


def sliding(events: DataFrame, size: str, slide: str, delay: str = "1 day", by: list[str] | None = None, ts: str = "ts") -> DataFrame:
    """Events and their exact total value in every window and key."""
    keys = by or ["event_type"]
    grouped = _late(events, ts, delay).groupBy(F.window(ts, size, slide).alias("w"), *keys)
    out = grouped.agg(F.count("*").alias("n_events"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), *keys, "n_events", "total")


def sessions(events: DataFrame, gap: str = "12 hours", delay: str = "1 day", key: str = "user_id", ts: str = "ts") -> DataFrame:
    """Events of a key without a pause of gap or longer between them."""
    out = _late(events, ts, delay).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n_events"))
    return out.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events")


def distinct(events: DataFrame, keys: list[str], delay: str = "1 day", ts: str = "ts") -> DataFrame:
    """Each event once; on a stream, repeats are recognised within the watermark."""
    return _late(events, ts, delay).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def run_available(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Process what is there and stop: incremental loads pick up where the checkpoint ends."""
    stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).option("path", path).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
