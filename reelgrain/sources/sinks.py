"""Writers: dataset folders, JSON lines, statistics, and checks of what was written."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_episodes(frames: DataFrame, root: str, *, chunk_size: int = 1000, overwrite: bool = False) -> None:
    """Frames under ``root/data/chunk=...``, each episode's frames together and in order.

    An existing folder is an error unless ``overwrite``. Rows of a chunk are spread by episode, so one
    chunk is written by many tasks.
    """
    rows = frames.withColumn("chunk", F.floor(F.col("episode_index") / chunk_size).cast("bigint"))
    rows.repartition("chunk", "episode_index").sortWithinPartitions("chunk", "episode_index", "frame_index").write.mode("overwrite" if overwrite else "errorifexists").partitionBy("chunk").parquet(f"{root}/data")


def write_episode_files(frames: DataFrame, root: str, *, chunk_size: int = 1000, overwrite: bool = False) -> None:
    """One file per episode, in a folder of its own under its chunk's: ``root/data/chunk=.../episode=...``."""
    rows = frames.withColumn("chunk", F.floor(F.col("episode_index") / chunk_size).cast("bigint")).withColumn("episode", F.col("episode_index"))
    rows.repartition("chunk", "episode").sortWithinPartitions("chunk", "episode", "frame_index").write.mode("overwrite" if overwrite else "errorifexists").partitionBy("chunk", "episode").parquet(f"{root}/data")


def append_worker_lines(df: DataFrame, root: str, worker: str) -> None:
    """Answers and error rows below ``root/worker=...`` of their worker, beside what is there."""
    df.write.mode("append").partitionBy(worker).json(root)


def write_json_lines(df: DataFrame, path: str, *, append: bool = False, overwrite: bool = False) -> None:
    df.write.mode("append" if append else "overwrite" if overwrite else "errorifexists").json(path)


def write_csv(df: DataFrame, path: str, *, overwrite: bool = False) -> None:
    df.write.mode("overwrite" if overwrite else "errorifexists").option("header", True).csv(path)


def stats_json(stats: DataFrame, feature: str) -> DataFrame:
    """Statistics by dimension as one JSON text: mean, std, q01 and q99 of a feature."""
    names = ("mean", "std", "q01", "q99")
    rows = stats.agg(F.array_sort(F.collect_list(F.struct("dim", *names))).alias("s"))
    record = F.struct(*(F.col(f"s.{n}").alias(n) for n in names))
    return rows.select(F.to_json(F.struct(F.struct(record.alias(feature)).alias("norm_stats"))).alias("value"))


def read_stats(text: DataFrame, feature: str) -> DataFrame:
    """Statistics by dimension back from their JSON text."""
    kind = "array<double>"
    schema = f"norm_stats struct<`{feature}`: struct<mean: {kind}, std: {kind}, q01: {kind}, q99: {kind}>>"
    one = text.select(F.from_json("value", schema).alias("v")).select(f"v.norm_stats.`{feature}`.*")
    return one.select(F.posexplode(F.arrays_zip("mean", "std", "q01", "q99")).alias("dim", "s")).select(F.col("dim").cast("bigint").alias("dim"), "s.*")


def written_as_told(spark: SparkSession, root: str, episodes: DataFrame) -> DataFrame:
    """Episodes whose written frames aren't as many as their length says."""
    have = spark.read.parquet(f"{root}/data").groupBy("episode_index").agg(F.count("*").alias("frames"))
    return episodes.join(have, "episode_index", "full").filter("not (length <=> frames)").select("episode_index", "length", "frames")


def next_number(outputs: DataFrame, name: str = "name") -> DataFrame:
    """The next free number of outputs named by numbers."""
    number = F.when(F.col(name).rlike(r"\d+$"), F.regexp_extract(name, r"(\d+)$", 1).cast("bigint"))
    return outputs.agg((F.coalesce(F.max(number), F.lit(-1)) + 1).alias("next"))


def renumbered_media(media: DataFrame, offsets: DataFrame, key: Sequence[str]) -> DataFrame:
    """Where each media file goes when episodes get new numbers: ``path`` and ``target``."""
    rows = media.join(offsets, list(key))
    return rows.select("path", F.regexp_replace("path", F.lit(r"episode_\d+"), F.format_string("episode_%06d", F.col("new_index"))).alias("target"))
