"""Windowed aggregates, sessions and deduplication, the same code for batch and stream (an extension, survey 2.13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(df: DataFrame, at: str, key: str, value: str, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """(start, end, key, n, total) of tumbling or sliding windows. On a stream, rows later than ``late`` are dropped by the watermark."""
    if df.isStreaming:
        df = df.withWatermark(at, late)
    w = F.window(F.col(at), size, slide) if slide else F.window(F.col(at), size)
    g = df.groupBy(w.alias("_w"), F.col(key)).agg(F.count("*").alias("n"), F.round(F.sum(value), 2).alias("total"))
    return g.select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), key, "n", "total")


def sessions(df: DataFrame, at: str, key: str, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(start, end, key, n) of each key's sessions, which end after ``gap`` without a row."""
    if df.isStreaming:
        df = df.withWatermark(at, late)
    g = df.groupBy(F.session_window(F.col(at), gap).alias("_w"), F.col(key)).agg(F.count("*").alias("n"))
    return g.select(F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), key, "n")


def deduplicated(df: DataFrame, at: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """Rows with new keys; a stream forgets keys after the watermark."""
    return df.withWatermark(at, late).dropDuplicatesWithinWatermark(keys) if df.isStreaming else df.dropDuplicates(keys)
