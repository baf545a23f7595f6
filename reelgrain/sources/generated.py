"""Rows made from a description, the same for the same seed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def uniform(seed: int, *salt: Column) -> Column:
    """A number in [0, 1) from a hash of the row."""
    return F.pmod(F.xxhash64(F.lit(seed), *salt), F.lit(1 << 52)) / float(1 << 52)


def generated(spark: SparkSession, rows: int, spec: Mapping[str, str | tuple[str, int]], seed: int = 0) -> DataFrame:
    """``index`` and, by name: ``float`` in [-1, 1), ``int`` in [0, 2048), or a vector of either as (kind, length); else 0."""

    def value(name: str, kind: str, place: Column) -> Column:
        x = uniform(seed, F.lit(name), F.col("index"), place)
        return {"float": (x * 2 - 1).cast("float"), "int": F.floor(x * 2048).cast("int")}.get(kind, F.lit(0))

    def column(name: str, kind: str | tuple[str, int]) -> Column:
        if isinstance(kind, str):
            return value(name, kind, F.lit(0))
        return F.transform(F.sequence(F.lit(1), F.lit(kind[1])), lambda i: value(name, kind[0], i))

    df = spark.range(rows).withColumnRenamed("id", "index")
    return df.withColumns({n: column(n, k) for n, k in spec.items()})


ROBOTS = {
    "bimanual": {"state": ("float", 14)},
    "single_arm": {"joint_position": ("float", 7), "gripper_position": ("float", 1)},
    "simulated": {"state": ("float", 8)},
    "dexterous": {"state": ("float", 31)},
}


def observations(spark: SparkSession, robot: str, rows: int, seed: int = 0) -> DataFrame:
    """Example observations of a kind of robot, with a prompt."""
    return generated(spark, rows, ROBOTS[robot], seed).withColumn("prompt", F.lit("do something"))
