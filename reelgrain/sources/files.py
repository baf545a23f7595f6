"""Readers of the files around recordings: JSON lines, documents, key ranges, listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPISODES = "episode_index bigint, tasks array<string>, length bigint"
TASKS = "task_index bigint, task string"
WORKER_LINES = "base_name string, start_second int, end_second int, task_description string, error string"
HAND = "struct<grasp_type:string,grasp_category:string,opposition_type:string,thumb_position:string,virtual_fingers:string,object_shape:string,contact_region:string>"
SECONDS = f"second int, frame_indices array<int>, analysis struct<active_hands:array<string>,hands:map<string,{HAND}>,description:string>"


def json_lines(spark: SparkSession, path: str | Sequence[str], schema: str, *, bad: bool = False) -> DataFrame:
    """JSON lines with a fixed schema; blank and broken lines are skipped, or given alone with ``bad``."""
    paths = [path] if isinstance(path, str) else list(path)
    kind = T.StructType([*T._parse_datatype_string(schema).fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(paths).filter("trim(value) <> ''")
    rows = lines.select(F.from_json("value", kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("r.*")
    return rows.filter("_corrupt_record is not null").select("_corrupt_record") if bad else rows.filter("_corrupt_record is null").drop("_corrupt_record")


def json_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def range_map(spark: SparkSession, path: str) -> DataFrame:
    """A file with a map of episode keys to half-open ranges: ``key``, ``start``, ``end``."""
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json("value", "map<string, array<array<int>>>")).alias("key", "ranges"))
    return rows.select("key", F.explode("ranges").alias("r")).select("key", F.col("r")[0].alias("start"), F.col("r")[1].alias("end"))


def range_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a key-range file with their numbers, for the range operators."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.split("value", "\r?\n")).alias("line", "value"))


def listed(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder without their contents: ``path``, ``name``, ``length``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.withColumn("name", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]+)?$", 1)).select("path", "name", "length")


def not_done(files: DataFrame, outputs: DataFrame, least: int = 1000) -> DataFrame:
    """Files without an output of their name of more than ``least`` bytes."""
    return files.join(outputs.filter(F.col("length") > least).select("name"), "name", "left_anti")


def episodes_of(spark: SparkSession, root: str, numbers: Sequence[int] | None = None, chunk_size: int = 1000) -> DataFrame:
    """Frames of a dataset folder partitioned by ``chunk``; with ``numbers`` only their chunks are opened."""
    rows = spark.read.parquet(f"{root}/data")
    if numbers is None:
        return rows
    chunks = sorted({n // chunk_size for n in numbers})
    return rows.filter(F.col("chunk").isin(chunks) & F.col("episode_index").isin(list(numbers)))


def matches(path: Column, pattern: str) -> Column:
    """Whether the whole path matches."""
    return path.rlike(f"^(?:{pattern})$")


def steps(trajectories: DataFrame, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Records of arrays over steps as one row per step: ``step`` and the fields' values at it."""
    rows = trajectories.select(*keep, F.posexplode(F.arrays_zip(*(F.col(f).alias(f.split(".")[-1]) for f in fields))).alias("step", "_s"))
    return rows.select(*keep, F.col("step").cast("bigint").alias("step"), "_s.*")


def equal_lengths(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The rows, or a failure where arrays over the same steps differ in length."""
    sizes = F.array_distinct(F.array(*(F.size(f) for f in fields)))
    return df.filter(F.assert_true(F.size(sizes) == 1, F.lit(f"{', '.join(fields)} differ in length")).isNull())
