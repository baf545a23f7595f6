"""Chunk brokers replayed over stored requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def replayed(df: DataFrame, keys: Sequence[str], order: str, chunk: str, every: int) -> DataFrame:
    """What a broker emits that asks for a chunk every ``every`` frames and then steps through it.

    ``order`` numbers a key's frames without gaps. The frames between two requests are one group of
    at most ``every`` rows, so no group grows with the recording.
    """
    anchor = F.floor(F.col(order) / every).cast("bigint")
    first = F.first(F.col(chunk)).over(Window.partitionBy(*keys, "_a").orderBy(order))
    rows = df.withColumn("_a", anchor).withColumn("_c", first)
    return rows.withColumn("emitted", F.get("_c", (F.col(order) - F.col("_a") * every).cast("int"))).drop("_a", "_c")
