"""Datasets put together: common columns, dictionaries, new numbers, checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgrain.operators.chunks import numbered


def union_common(parts: Sequence[DataFrame], index: str = "dataset_index") -> DataFrame:
    """All rows with the columns that every part has, and the number of the part. None in common is an error."""
    common = [c for c in parts[0].columns if all(c in p.columns for p in parts)]
    if not common:
        raise ValueError("the datasets have no column in common")
    return reduce(DataFrame.unionByName, (p.select(*(F.col(f"`{c}`") for c in common)).withColumn(index, F.lit(i).cast("bigint")) for i, p in enumerate(parts)))


def left_out(parts: Sequence[DataFrame]) -> list[set[str]]:
    """The columns of each part that not all have."""
    common = set.intersection(*(set(p.columns) for p in parts))
    return [set(p.columns) - common for p in parts]


def dictionary(df: DataFrame, text: str, order: Sequence[str], number: str = "task_index") -> DataFrame:
    """Distinct texts numbered by where they first appear."""
    first = df.filter(F.col(text).isNotNull()).groupBy(text).agg(F.min(F.struct(*order)).alias("_first"))
    return numbered(first, ["_first"], number).select(number, text)


def joined_task(frames: DataFrame, tasks: DataFrame, *, strict: bool = False) -> DataFrame:
    """Frames with their task's text. ``strict``: an unknown number fails the job when it is read."""
    rows = frames.join(tasks.select("task_index", "task"), "task_index", "left")
    if strict:
        known = F.assert_true(F.col("task").isNotNull(), F.concat(F.lit("task_index="), F.coalesce(F.col("task_index").cast("string"), F.lit("null")), F.lit(" not found in task mapping")))
        rows = rows.filter(known.isNull())
    return rows


def retasked(frames: DataFrame, episodes: DataFrame, tasks: DataFrame) -> DataFrame:
    """Frames with the number of their episode's first task; where that is unknown they keep their own."""
    wanted = episodes.groupBy("episode_index").agg(F.min(F.get("tasks", F.lit(0))).alias("task")).join(tasks.select("task", F.col("task_index").alias("_new")), "task")
    rows = frames.join(wanted.select("episode_index", "_new"), "episode_index", "left")
    return rows.withColumn("task_index", F.coalesce("_new", "task_index")).drop("_new")


def updated_tasks(episodes: DataFrame, annotations: DataFrame, key: str, order: Sequence[str], text: str) -> DataFrame:
    """Episodes with their first annotation as only task where there is one."""
    first = annotations.groupBy(key).agg(F.min_by(text, F.struct(*order)).alias("_text"))
    rows = episodes.join(first, key, "left")
    return rows.withColumn("tasks", F.when(F.col("_text").isNotNull(), F.array("_text")).otherwise(F.col("tasks"))).drop("_text")


def appended(base: DataFrame, more: DataFrame, number: str, order: Sequence[str]) -> DataFrame:
    """``more`` below ``base``, numbered on from its largest number."""
    offset = base.agg((F.coalesce(F.max(number), F.lit(-1)) + 1).cast("bigint").alias("_offset"))
    placed = numbered(more.drop(number), order, number).withColumn("_one", F.lit(1))
    placed = placed.join(F.broadcast(offset.withColumn("_one", F.lit(1))), "_one").withColumn(number, F.col(number) + F.col("_offset")).drop("_one", "_offset")
    return base.unionByName(placed.select(*base.columns))


def conflicts(df: DataFrame, key: str, same: Sequence[str]) -> DataFrame:
    """Keys whose rows differ in what must be the same, with the number of values of each."""
    counts = df.groupBy(key).agg(*(F.count_distinct(c).alias(c) for c in same))
    return counts.filter(reduce(lambda a, b: a | b, (F.col(c) > 1 for c in same)))


def reindexed(frames: DataFrame, offsets: DataFrame) -> DataFrame:
    """Frames numbered over all data: their episode's start and their place in it."""
    return frames.join(offsets.select("episode_index", "from"), "episode_index").withColumn("index", F.col("from") + F.col("frame_index")).drop("from")


def chunk_counts(frames: DataFrame, size: int) -> DataFrame:
    """Frames per episode, and the number of chunks of ``size`` that hold them (at least one)."""
    return frames.groupBy("episode_index").agg(F.count("*").alias("frames"), F.greatest(F.ceil(F.count("*") / size), F.lit(1)).cast("bigint").alias("chunks"))


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.select(*(F.col(f"`{c}`").alias(names.get(c, c)) for c in df.columns))
