"""Streaming extension: per-cell statistics as events arrive. The batch operators are the reference for its results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, ts: str = "ts", key: str = "event_type", value: str = "value", size: str = "1 hour", late: str = "2 hours", slide: str | None = None) -> DataFrame:
    """Count and sum for each key and window, tumbling or, with ``slide``, sliding; works on batch frames and, with a watermark, on streams."""
    d = events.withWatermark(ts, late) if events.isStreaming else events
    return d.groupBy(F.window(ts, size, slide).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), key, "n", "total")


def sessions(events: DataFrame, ts: str = "ts", user: str = "user_id", gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    d = events.withWatermark(ts, late) if events.isStreaming else events
    return d.groupBy(F.session_window(ts, gap).alias("w"), user).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), user, "n")
