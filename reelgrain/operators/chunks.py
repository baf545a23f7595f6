"""Windows over ordered frames: action chunks, two-sided looks, timing checks, running numbers.

Frames of one key are cut into blocks of consecutive order numbers, and each block gets copies of the few
frames around it that its windows reach. So a single long recording is spread over many tasks, and each
operator needs one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgrain.session import materialize

BLOCK = 8192
CELL = 1 << 20


def blocked(df: DataFrame, order: str, behind: int, ahead: int, block: int = BLOCK) -> DataFrame:
    """The rows with ``_block``, copied to each block within ``behind`` and ``ahead`` of them, and ``_own``."""
    at = F.floor(F.col(order) / block).cast("bigint")
    inside = lambda b: F.col(order).between(b * block - behind, (b + 1) * block - 1 + ahead)
    return df.withColumn("_block", F.explode(F.filter(F.array(at - 1, at, at + 1), inside))).withColumn("_own", F.col("_block") == at)


def action_chunk(df: DataFrame, keys: Sequence[str], order: str, value: str, horizon: int, out: str = "chunk") -> DataFrame:
    """The next ``horizon`` values from each frame on, the last one repeated at the end of the recording.

    ``order`` numbers the frames of a key without gaps; ``real`` tells how many values are not repeats.
    """
    w = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(0, horizon - 1)
    rows = blocked(df, order, 0, horizon - 1).withColumn("_c", F.collect_list(F.struct(F.col(value).alias("v"))).over(w)).filter("_own")
    chunk = F.col("_c.v")
    filled = F.concat(chunk, F.array_repeat(F.element_at(chunk, -1), F.lit(horizon) - F.size("_c")))
    return rows.withColumn(out, filled).withColumn("real", F.size("_c")).drop("_c", "_block", "_own")


def delta_query(df: DataFrame, keys: Sequence[str], order: str, value: str, deltas: Sequence[int]) -> DataFrame:
    """Values at fixed distances, clamped to the recording on both sides, with a flag where that happened.

    One row per frame and distance: the input columns, ``delta``, ``looked`` (the value) and ``is_pad``.
    """
    far = max(abs(d) for d in deltas)
    w = Window.partitionBy(*keys, "_block").orderBy(order)
    first, last = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing), w
    rows = blocked(df, order, far, far)

    def look(d: int) -> Column:
        there = (F.lead("_v", d) if d >= 0 else F.lag("_v", -d)).over(last)
        edge = (F.last("_v") if d >= 0 else F.first("_v")).over(first)
        return F.struct(F.lit(d).cast("bigint").alias("delta"), F.coalesce(there, edge)["v"].alias("looked"), there.isNull().alias("is_pad"))

    rows = rows.withColumn("_v", F.struct(F.col(value).alias("v"))).withColumn("_l", F.array(*(look(d) for d in deltas))).filter("_own")
    names = [c for c in df.columns]
    return rows.select(*(F.col(f"`{c}`") for c in names), F.explode("_l").alias("_x")).select(*(F.col(f"`{c}`") for c in names), "_x.delta", "_x.looked", "_x.is_pad")


def irregular_steps(df: DataFrame, keys: Sequence[str], order: str, seconds: str, fps: str, tolerance: float) -> DataFrame:
    """Frames whose time from the frame before differs from 1 / fps by more than the tolerance; starts never do."""
    w = Window.partitionBy(*keys, "_block").orderBy(order)
    rows = blocked(df, order, 1, 0).withColumn("step", F.col(seconds).cast("double") - F.lag(F.col(seconds).cast("double")).over(w)).filter("_own")
    return rows.filter(F.abs(F.col("step") - 1 / F.col(fps)) > tolerance).drop("_block", "_own")


def running_total(df: DataFrame, order: Sequence[str], value: str, out: str, *, partitions: int | None = None) -> DataFrame:
    """Exclusive running sum of ``value`` over the whole table in a total ``order``, without a single task.

    Rows are sorted by ranges; the sums of the ranges, one row each, are accumulated and added to the
    running sums inside the ranges.
    """
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order).withColumn("_p", F.spark_partition_id())
    ranged = materialize(ranged)
    along = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_p").agg(F.sum(value).alias("_s")).withColumn("_before", F.coalesce(F.sum("_s").over(along), F.lit(0))).select("_p", "_before")
    inside = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return rows.join(F.broadcast(sums), "_p").withColumn(out, (F.col("_before") + F.col("_in")).cast("bigint")).drop("_p", "_in", "_before")


def numbered(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Dense numbers from 0 over the whole table in a total ``order``."""
    return running_total(df.withColumn("_1", F.lit(1)), order, "_1", out).drop("_1")


def data_index(episodes: DataFrame) -> DataFrame:
    """Where each episode's frames start and end in the concatenated data."""
    rows = running_total(episodes.select("episode_index", "length"), ["episode_index"], "length", "from")
    return rows.select("episode_index", "from", (F.col("from") + F.col("length")).alias("to"))


def ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], *, partitions: int | None = None) -> DataFrame:
    """The rows sorted by ranges of key and order, with their partition as ``_p``.

    A key of any size is spread over as many partitions as its rows fill; what the functions below
    carry from one partition to the next is one row per key and partition.
    """
    return materialize(df.repartitionByRange(*([partitions] if partitions else []), *keys, *order).withColumn("_p", F.spark_partition_id()))


def _beside(rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with what is carried to their key and partition; null keys are keys too."""
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    carried = carried.select(F.col("_p").alias("_partition"), *(F.col(k).alias(n) for k, n in names.items()), *(c for c in carried.columns if c not in ("_p", *keys)))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()), F.col("_p") == F.col("_partition"))
    return rows.join(carried, same).drop("_partition", *names.values())


def total_in(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str | Column, out: str) -> DataFrame:
    """The sum of ``value`` over the rows of the key before each row of :func:`ranged` rows (0 at the first)."""
    rows = rows.withColumn("_own_value", F.coalesce(F.col(value) if isinstance(value, str) else value, F.lit(0)))
    along = Window.partitionBy(*keys).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_p", *keys).agg(F.sum("_own_value").alias("_s")).withColumn("_sum_before", F.coalesce(F.sum("_s").over(along), F.lit(0))).drop("_s")
    inside = Window.partitionBy("_p", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    here = rows.withColumn("_inside", F.coalesce(F.sum("_own_value").over(inside), F.lit(0)))
    return _beside(here, sums, keys).withColumn(out, F.col("_sum_before") + F.col("_inside")).drop("_own_value", "_inside", "_sum_before")


def last_in(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, *, before: bool = False, backward: bool = False) -> DataFrame:
    """The last ``value`` that is not null up to each row of :func:`ranged` rows, or from it on with ``backward``.

    ``before``: of the rows before it only, not of its own. Wrap values that may be null in a struct.
    """
    rows = rows.withColumn("_own_value", value)
    turned = [F.desc(o) if backward else F.asc(o) for o in order]
    ends = (F.min_by if backward else F.max_by)("_own_value", F.when(F.col("_own_value").isNotNull(), F.struct(*order)))
    along = Window.partitionBy(*keys).orderBy(F.desc("_p") if backward else F.asc("_p")).rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("_p", *keys).agg(ends.alias("_e")).withColumn("_carried", F.last("_e", ignorenulls=True).over(along)).drop("_e")
    inside = Window.partitionBy("_p", *keys).orderBy(*turned).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    here = rows.withColumn("_inside", F.last("_own_value", ignorenulls=True).over(inside))
    return _beside(here, carried, keys).withColumn(out, F.coalesce("_inside", "_carried")).drop("_own_value", "_inside", "_carried")


def numbered_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Dense numbers from 0 inside each key, in a total ``order``."""
    return total_in(ranged(df, keys, order), keys, order, F.lit(1), out).withColumn(out, F.col(out).cast("bigint")).drop("_p")


def locate(positions: DataFrame, lengths: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Global row numbers as dataset and local row; ``lengths`` lists the datasets in order with ``rows``.

    The list of datasets is small; positions outside of all are left out.
    """
    w = Window.orderBy(dataset).rowsBetween(Window.unboundedPreceding, -1)
    ranges = lengths.withColumn("_from", F.coalesce(F.sum("rows").over(w), F.lit(0))).withColumn("_to", F.col("_from") + F.col("rows"))
    # Each dataset is listed in the cells of 2^20 rows that it reaches, so that a position looks up those of its cell alone.
    cells = ranges.filter("rows > 0").withColumn("_cell", F.explode(F.sequence(F.expr(f"_from div {CELL}"), F.expr(f"(_to - 1) div {CELL}"))))
    found = positions.filter("position >= 0").withColumn("_cell", F.expr(f"position div {CELL}")).join(cells, "_cell").filter("position >= _from and position < _to")
    return found.select("position", dataset, (F.col("position") - F.col("_from")).cast("bigint").alias("local"))
