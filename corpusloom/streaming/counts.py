"""Counts over streams; the stateless functions of the engine run on streams unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def running_counts(stream: DataFrame, keys: list[str], token: str = "token") -> DataFrame:
    """Counts so far, for update or complete mode."""
    return stream.groupBy(*keys, token).agg(F.count("*").alias("count"))


def windowed_counts(stream: DataFrame, time: str, keys: list[str], size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per window; rows later than the watermark are left out and closed windows leave the state."""
    return stream.withWatermark(time, late).groupBy(F.window(time, size), *keys).agg(F.count("*").alias("count"))


def drain(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what is there now and returns the result table."""
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
