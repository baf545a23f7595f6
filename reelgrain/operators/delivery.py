"""At-least-once deliveries: keep one line of each message.

The store is a bucketed table of runs. A run holds, for a named slice of the deliveries, one row per
message identifier, hashed into buckets and sorted inside each of them. Compaction reads bucket by
bucket, without a shuffle, merges the buckets' sorted runs and lets equal identifiers collapse to the
line that was delivered first. Writing a run again replaces the whole of it, so an upsert may be
repeated after a failure without any effect.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelgrain.session import file_system, scratch_path

BUCKET_ROWS = 2_000_000
_MODE = "spark.sql.sources.partitionOverwriteMode"


def clip_key(name: Column) -> Column:
    """A clip's name without folder, file extension, letter case and blanks at the ends."""
    bare = F.regexp_replace(name, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    bare = F.regexp_replace(bare, r"^.*[/\\]", "")
    bare = F.regexp_replace(bare, r"(?<=.)\.[A-Za-z0-9]{1,5}$", "")
    return F.lower(F.regexp_replace(bare, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


@contextmanager
def _replacing_runs(spark: SparkSession) -> Iterator[None]:
    """Overwriting replaces the partitions that are written, and no others."""
    before = spark.conf.get(_MODE, None)
    spark.conf.set(_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.unset(_MODE) if before is None else spark.conf.set(_MODE, before)


class RunStore:
    """Hash-bucketed, sorted runs of (identifier, order) rows under one folder.

    ``kinds``: the SQL types of the keys and the order, by name. A store that is opened again must be
    given the same keys, order and number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: str, kinds: dict[str, str], buckets: int = 16) -> None:
        self.spark, self.path, self.keys, self.order, self.buckets = spark, path, list(keys), order, buckets
        self.table = f"runs_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{c}` {kinds[c]}" for c in [*self.keys, order])
        names = ", ".join(f"`{k}`" for k in self.keys)
        files, where = file_system(spark, path)
        files.mkdirs(where)
        spark.sql(
            f"CREATE TABLE {self.table} ({columns}, _run string) USING parquet PARTITIONED BY (_run) CLUSTERED BY ({names}) SORTED BY ({names}, `{order}`) INTO {buckets} BUCKETS LOCATION '{path}'"
        )
        spark.sql(f"MSCK REPAIR TABLE {self.table}")

    def upsert(self, rows: DataFrame, run: str | Column) -> None:
        """Write the rows as the run named ``run``, or, by a column, as several runs at once.

        A run is replaced as a whole: it must be sent with all of its rows, and other deliveries need
        another name. Equal identifiers are folded before the shuffle, so a message that was delivered
        any number of times costs one row per task. Rows with a null in the identifier are not stored.
        """
        if run is None:
            raise ValueError("a run needs a name")
        named = F.lit(run) if isinstance(run, str) else run.cast("string")
        rows = rows.dropna(subset=self.keys).withColumn("_run", named)
        folded = rows.groupBy("_run", *self.keys).agg(F.min(self.order).alias(self.order))
        # Spark's own bucket of a row is its partition here, so each task writes one file per run.
        placed = folded.repartition(self.buckets, *self.keys).select(*self.keys, self.order, "_run")
        if isinstance(run, str) and not rows.take(1):
            quoted = run.replace("\\", "\\\\").replace("'", "\\'")
            files, where = file_system(self.spark, f"{self.path}/_run={run}")
            files.delete(where, True)
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (_run = '{quoted}')")
            return
        with _replacing_runs(self.spark):
            placed.write.insertInto(self.table, overwrite=True)

    def compact(self) -> DataFrame:
        """One row per identifier: that with the smallest order of all runs.

        All files of a bucket are read by one task. They are sorted runs, which Spark's sort finds and
        merges; the first row of each identifier stays.
        """
        place = F.row_number().over(Window.partitionBy(*self.keys).orderBy(self.order))
        return self.spark.table(self.table).select(*self.keys, self.order).withColumn("_place", place).filter("_place = 1").drop("_place")


def surplus_deliveries(lines: DataFrame, *, runs: int = 4, buckets: int | None = None) -> DataFrame:
    """The ``line_id`` of every line whose message has a line with a smaller ``line_id``.

    A message is ``start_second`` and the clip's name by :func:`clip_key`. Lines with a null in
    either, or without ``line_id``, belong to no message and are never surplus; repeated rows count
    once; an empty table gives an empty result; further columns are ignored. A name that is blank
    apart from folder and extension is a name like others. Unless a number of ``buckets`` is given,
    each holds about ``BUCKET_ROWS`` deliveries, with 16 at least. The table is stored as ``runs`` slices of
    its batches, all of which are written at once.
    """
    spark = lines.sparkSession
    buckets = buckets or max(16, -(-lines.count() // BUCKET_ROWS))
    messages = lines.filter("line_id is not null").select("line_id", "batch_id", "start_second", clip_key(F.col("base_name")).alias("clip"))
    kinds = {c: messages.schema[c].dataType.simpleString() for c in ("clip", "start_second", "line_id")}
    store = RunStore(spark, scratch_path(spark, "deliveries"), ["clip", "start_second"], "line_id", kinds, buckets)
    store.upsert(messages, F.concat(F.lit("slice-"), F.pmod(F.coalesce("batch_id", F.lit(0)), F.lit(runs))))
    kept = store.compact().select("line_id")
    known = messages.filter("clip is not null and start_second is not null").select("line_id").distinct()
    return known.join(kept, "line_id", "left_anti")


def deduplicated_lines(lines: DataFrame, *, buckets: int | None = None) -> DataFrame:
    """The lines without the surplus ones: one of each message, and all that have no identifier."""
    surplus = surplus_deliveries(lines, buckets=buckets)
    return lines.distinct().join(surplus, "line_id", "left_anti")
