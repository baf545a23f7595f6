"""Statistics of vectors and signals: per dimension, grouped, pooled, and their use for normalization."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def readings(df: DataFrame, vector: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element: ``keep``, ``dim`` (from 0), ``x`` as double; null vectors give none."""
    return df.select(*keep, F.posexplode(F.col(f"`{vector}`")).alias("dim", "x")).select(*keep, F.col("dim").cast("bigint").alias("dim"), F.col("x").cast("double").alias("x"))


def vector_stats(df: DataFrame, vector: str, by: Sequence[str] = (), *, quantiles: bool = True, accuracy: int | None = None, finite: bool = False) -> DataFrame:
    """Count, mean, population deviation, extremes and the 1st and 99th percentile of each dimension.

    Partial aggregates are merged after the shuffle, whose rows are one per task, group and dimension.
    Exact percentiles interpolate and buffer the distinct values of a group. With ``accuracy`` they
    are readings whose rank is off by at most n / accuracy, from one mergeable sketch whose size
    doesn't grow with the rows. ``finite``: only finite readings count.
    """
    rows = readings(df, vector, by)
    if finite:
        rows = rows.filter("abs(x) < double('Infinity')")
    aggregates = [F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.min("x").alias("low"), F.max("x").alias("high")]
    if not quantiles:
        return rows.groupBy(*by, "dim").agg(*aggregates)
    if accuracy is None:
        return rows.groupBy(*by, "dim").agg(*aggregates, F.percentile("x", 0.01).alias("q01"), F.percentile("x", 0.99).alias("q99"))
    out = rows.groupBy(*by, "dim").agg(*aggregates, F.percentile_approx("x", [0.01, 0.99], accuracy).alias("_q"))
    return out.withColumns({"q01": F.col("_q")[0].cast("double"), "q99": F.col("_q")[1].cast("double")}).drop("_q")


def signal_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    x = F.col(value)
    return df.groupBy(*by).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("variance"), F.min(x).alias("low"), F.max(x).alias("high"))


def pooled(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Statistics of the union from those of its parts: weighted means, and variance within and between."""
    n, mean, variance = F.col("n"), F.col("mean"), F.col("variance")
    total, first, second = F.sum(n), F.sum(n * mean), F.sum(n * (variance + mean * mean))
    center = first / total
    return stats.groupBy(*by).agg(total.alias("n"), center.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), second / total - center * center)).alias("std"), F.min("low").alias("low"), F.max("high").alias("high"))


def as_arrays(stats: DataFrame, names: Sequence[str]) -> DataFrame:
    """Statistics of all dimensions as one row of arrays; its size is that of one vector."""
    ordered = F.array_sort(F.collect_list(F.struct("dim", *names)))
    return stats.agg(ordered.alias("s")).select(*(F.col(f"s.{c}").alias(c) for c in names))


def with_stats(df: DataFrame, stats: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each row beside the one row of statistics."""
    one = as_arrays(stats, names).withColumn("_one", F.lit(1))
    return df.withColumn("_one", F.lit(1)).join(F.broadcast(one), "_one").drop("_one")


def histogram_quantiles(df: DataFrame, vector: str, shares: Sequence[float], bins: int = 5000) -> DataFrame:
    """Quantiles by equal bins between the extremes: the left edge of the first bin that reaches the share.

    Two passes and a table of bins, whatever the number of rows.
    """
    rows = readings(df, vector)
    edges = rows.groupBy("dim").agg((F.min("x") - 1e-10).alias("low"), (F.max("x") + 1e-10).alias("high"), F.count("x").alias("n"))
    binned = rows.join(F.broadcast(edges), "dim").withColumn("bin", F.least(F.floor((F.col("x") - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1)).cast("bigint"))
    counts = binned.groupBy("dim", "low", "high", "n", "bin").agg(F.count("*").alias("c"))
    listed = counts.groupBy("dim", "low", "high", "n").agg(F.array_sort(F.collect_list(F.struct("bin", "c"))).alias("b"))

    def first(q: float) -> Column:
        reach = F.aggregate(
            "b",
            F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-1).cast("bigint").alias("at")),
            lambda s, b: F.struct((s["sum"] + b["c"]).alias("sum"), F.when((s["at"] < 0) & (s["sum"] + b["c"] >= F.lit(q) * F.col("n")), b["bin"]).otherwise(s["at"]).alias("at")),
        )
        return (F.col("low") + reach["at"] * (F.col("high") - F.col("low")) / bins).alias(f"q{round(q * 100):02d}")

    return listed.select("dim", *(first(q) for q in shares))
