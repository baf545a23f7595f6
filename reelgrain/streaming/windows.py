"""Event-time windows; the same functions take a stream or a stored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def timed(df: DataFrame, time: str, late: str | None = None) -> DataFrame:
    """With ``time`` as a timestamp of the session's zone, and a watermark for streams."""
    rows = df.withColumn(time, F.col(time).cast("timestamp"))
    return rows.withWatermark(time, late) if late else rows


def _counts(df: DataFrame, window: Column, by: Sequence[str], value: str) -> DataFrame:
    out = df.groupBy(window.alias("_w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.unix_micros("_w.start").alias("start_us"), F.unix_micros("_w.end").alias("end_us"), *by, "n", "total")


def tumbling(df: DataFrame, time: str, length: str, by: Sequence[str], value: str) -> DataFrame:
    return _counts(df, F.window(time, length), by, value)


def sliding(df: DataFrame, time: str, length: str, slide: str, by: Sequence[str], value: str) -> DataFrame:
    return _counts(df, F.window(time, length, slide), by, value)


def session(df: DataFrame, time: str, gap: str, by: Sequence[str], value: str) -> DataFrame:
    return _counts(df, F.session_window(time, gap), by, value)


def newest(df: DataFrame, key: Sequence[str], time: str, value: str) -> DataFrame:
    """The last known value of each key."""
    return df.groupBy(*key).agg(F.max(time).alias(time), F.max_by(value, time).alias(value))


def once(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each key once within the watermark."""
    return df.dropDuplicatesWithinWatermark(list(key))
