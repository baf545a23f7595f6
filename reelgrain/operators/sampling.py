"""Order, samples, batches, shards: all by hashes, so that every run gives the same rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgrain.functions.scalars import stable_hash
from reelgrain.operators.chunks import numbered


def hashed(seed: int, *columns: str) -> Column:
    return stable_hash(F.lit(seed), *(F.col(c) for c in columns))


def shuffled(df: DataFrame, key: Sequence[str], seed: int, out: str = "place") -> DataFrame:
    """Every row with its place in an order that looks random: a range sort by hash, no single task."""
    return numbered(df.withColumn("_h", hashed(seed, *key)), ["_h", *key], out).drop("_h")


def shard(df: DataFrame, order: Sequence[str], shards: int, number: int) -> DataFrame:
    """Every ``shards``-th row of the order, from ``number`` on."""
    return numbered(df, order, "_n").filter(F.col("_n") % shards == number).drop("_n")


def batches(df: DataFrame, order: Sequence[str], size: int, most: int | None = None) -> DataFrame:
    """Rows with the number of their batch and their slot; an incomplete last batch is dropped.

    With ``most`` batches the rows are gone through again from the start until there are so many.
    """
    rows = numbered(df, order, "_n")
    full = rows.select(F.floor(F.count("*") / size).cast("bigint").alias("_full")).withColumn("_one", F.lit(1))
    rows = rows.withColumn("_one", F.lit(1)).join(F.broadcast(full), "_one").withColumn("batch", F.floor(F.col("_n") / size).cast("bigint")).filter("batch < _full")
    if most is not None:
        again = F.sequence(F.col("batch"), F.lit(most - 1).cast("bigint"), F.col("_full"))
        rows = rows.filter(F.col("batch") < most).withColumn("batch", F.explode(again))
    return rows.withColumn("slot", F.col("_n") % size).drop("_n", "_one", "_full")


def mixed(df: DataFrame, source: str, key: Sequence[str], weights: Mapping[str, float], total: int, seed: int) -> DataFrame:
    """``total`` rows with the wanted share of each source; a source that is too small is repeated.

    ``copy`` numbers the repeats. The weights must add up to 1.
    """
    if abs(sum(weights.values()) - 1) > 1e-9:
        raise ValueError("the weights must add up to 1")
    parts = []
    for name, weight in weights.items():
        quota = round(weight * total)
        rows = shuffled(df.filter(F.col(source) == name), key, seed, "_n")
        have = rows.select(F.count("*").alias("_have")).withColumn("_one", F.lit(1))
        rows = rows.withColumn("_one", F.lit(1)).join(F.broadcast(have), "_one")
        copies = F.sequence(F.lit(0).cast("bigint"), F.floor((F.lit(quota - 1) - F.col("_n")) / F.col("_have")).cast("bigint"))
        parts.append(rows.filter(F.col("_n") < quota).withColumn("copy", F.explode(copies)).drop("_n", "_have", "_one"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def subset(df: DataFrame, key: Sequence[str], n: int, seed: int) -> DataFrame:
    """``n`` rows without replacement; a top-n by hash in every task first."""
    return df.orderBy(hashed(seed, *key), *key).limit(n)


def retained(steps: DataFrame, step: str, period: int) -> DataFrame:
    """Checkpoints to keep: the newest and every ``period``-th."""
    newest = steps.agg(F.max(step).alias("_top")).withColumn("_one", F.lit(1))
    rows = steps.withColumn("_one", F.lit(1)).join(F.broadcast(newest), "_one")
    return rows.filter((F.col(step) == F.col("_top")) | (F.col(step) % period == 0)).drop("_top", "_one")
