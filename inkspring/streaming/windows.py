"""Event-time windows; the same functions serve batch tables and streams. These extend what the engine must offer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(events: DataFrame, late: str | None) -> DataFrame:
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.withWatermark("ts", late) if late and rows.isStreaming else rows


def tumbling(events: DataFrame, size: str = "1 hour", late: str | None = "10 minutes") -> DataFrame:
    """start, event_type, n, total per window."""
    g = _timed(events, late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str = "2 hours", step: str = "1 hour", late: str | None = "10 minutes") -> DataFrame:
    g = _timed(events, late).groupBy(F.window("ts", size, step).alias("w")).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "12 hours", late: str | None = "10 minutes") -> DataFrame:
    g = _timed(events, late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), "n")
