"""Streams in and out: folders of requests, paced; and results as files or to subscribers."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def requests(spark: SparkSession, path: str, schema: str, *, per_trigger: int = 100) -> DataFrame:
    """JSON requests that appear in a folder, so many files at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(path)


def recorded(df: DataFrame, path: str, checkpoint: str, *, once: bool = True, every: str = "1 second") -> StreamingQuery:
    """Results as Parquet files; each is written exactly once, however often the stream is restarted."""
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def subscribed(df: DataFrame, subscribers: Sequence[Callable[[DataFrame, int], None]], checkpoint: str, *, once: bool = True, every: str = "1 second") -> StreamingQuery:
    """Each micro-batch handed to all subscribers in turn."""

    def hand_on(batch: DataFrame, number: int) -> None:
        batch.persist()
        for subscriber in subscribers:
            subscriber(batch, number)
        batch.unpersist()

    trigger = {"availableNow": True} if once else {"processingTime": every}
    return df.writeStream.foreachBatch(hand_on).option("checkpointLocation", checkpoint).trigger(**trigger).start()
