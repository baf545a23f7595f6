"""Metrics of runs: latency profiles, success, intervals, folds, rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgrain.operators.chunks import last_in, numbered_by, ranged, total_in


def profile(df: DataFrame, by: Sequence[str], value: str, accuracy: int | None = None) -> DataFrame:
    """Mean, deviation and percentiles of a metric.

    Exact percentiles buffer a group's distinct values; with ``accuracy`` they are values whose rank
    is off by at most n / accuracy, from a sketch whose size doesn't grow.
    """
    at = (lambda q: F.percentile(value, q)) if accuracy is None else (lambda q: F.percentile_approx(value, q, accuracy))
    shares = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), *(at(q).alias(f"p{round(q * 100):02d}") for q in shares))


def success_rate(df: DataFrame, by: Sequence[str], success: Column) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("episodes"), F.avg(success.cast("double")).alias("rate"))


def running_rate(df: DataFrame, by: Sequence[str], order: Sequence[str], success: Column, out: str = "rate") -> DataFrame:
    """The share of successes up to each row of its key, itself included; rows whose success is null don't count."""
    rows = ranged(df.withColumn("_y", success.cast("bigint")), by, order)
    rows = total_in(total_in(rows, by, order, "_y", "_won"), by, order, F.col("_y").isNotNull().cast("bigint"), "_all")
    won, played = F.col("_won") + F.coalesce("_y", F.lit(0)), F.col("_all") + F.col("_y").isNotNull().cast("bigint")
    return rows.withColumn(out, F.when(played > 0, won / played)).drop("_y", "_won", "_all", "_p")


def interval_mean(df: DataFrame, by: Sequence[str], step: str, value: str, every: int) -> DataFrame:
    """Mean per logging interval; step 0 stands alone, then 1 to ``every``, and so on."""
    return df.groupBy(*by, F.ceil(F.col(step) / every).cast("bigint").alias("interval")).agg(F.avg(value).alias("mean"))


def exponential_mean(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, decay: float) -> DataFrame:
    """Exponential moving average at the end of each key; the first value starts it.

    The fold is a weighted sum: a value k places before the end weighs decay ** k, and all but the first
    also 1 - decay. So it is aggregated in parts, and no key's values are held together.
    """
    rows = numbered_by(df, by, order, "_i")
    sizes = df.groupBy(*by).agg((F.count("*") - 1).alias("_last"))
    rows = rows.join(sizes, list(by)).withColumn("_k", (F.col("_last") - F.col("_i")).cast("double")).withColumn("_first", F.col("_i") == 0)
    weight = F.pow(F.lit(decay), F.col("_k")) * F.when(F.col("_first"), F.lit(1.0)).otherwise(F.lit(1 - decay))
    return rows.groupBy(*by).agg(F.sum(F.col(value) * weight).alias("ema"))


def arrival_rate(df: DataFrame, by: Sequence[str], seconds: Column, last: int | None = None) -> DataFrame:
    """Rows per second from the mean time between them; of the ``last`` rows only, if given.

    The times between add up to that from the first to the last row, so extremes and a count suffice.
    """
    rows = df.select(*by, seconds.alias("_t"))
    if last is not None:
        newest = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("_t")))
        rows = rows.withColumn("_n", newest).filter(F.col("_n") <= last).drop("_n")
    return rows.groupBy(*by).agg(((F.count("_t") - 1) / F.nullif(F.max("_t") - F.min("_t"), F.lit(0))).alias("hertz"))


def previous(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Each row with the value of the row before."""
    rows = last_in(ranged(df, by, order), by, order, F.struct(F.col(value).alias("v")), out, before=True)
    return rows.withColumn(out, F.col(f"{out}.v")).drop("_p")


def global_norm(df: DataFrame, value: str) -> DataFrame:
    return df.agg(F.sqrt(F.sum(F.col(value) * F.col(value))).alias("norm"))
