"""Idle motion: flags, runs, keep ranges, and frames inside ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgrain.operators.chunks import blocked


def still(now: Column, before: Column, epsilon: float) -> Column:
    """Whether no dimension moved by ``epsilon`` or more; false without a frame before."""
    moved = F.zip_with(now.cast("array<double>"), before.cast("array<double>"), lambda a, b: F.abs(a - b) < epsilon)
    return F.coalesce(F.forall(moved, lambda ok: F.coalesce(ok, F.lit(False))), F.lit(False))


def idle_flags(df: DataFrame, keys: Sequence[str], order: str, vector: str, epsilon: float = 1e-3) -> DataFrame:
    """``keys``, ``order`` and ``idle``; the first frame of a key never is."""
    w = Window.partitionBy(*keys, "_block").orderBy(order)
    rows = blocked(df.select(*keys, order, F.col(f"`{vector}`").alias("_v")), order, 1, 0)
    return rows.withColumn("idle", still(F.col("_v"), F.lag("_v").over(w), epsilon)).filter("_own").select(*keys, order, "idle")


def runs(df: DataFrame, keys: Sequence[str], order: str, flag: str, block: int = 8192) -> DataFrame:
    """Runs of equal flags over consecutive numbers: ``keys``, ``flag``, ``start`` and ``end`` (exclusive).

    Gaps and islands: inside a run, number and place differ by a constant. Recordings are cut into
    blocks; only runs that touch a block's edge meet again, to be joined.
    """
    w = Window.partitionBy(*keys, "_block", flag).orderBy(order)
    rows = df.withColumn("_block", F.floor(F.col(order) / block)).withColumn("_island", F.col(order) - F.row_number().over(w))
    pieces = rows.groupBy(*keys, "_block", flag, "_island").agg(F.min(order).alias("start"), (F.max(order) + 1).alias("end"))
    at_edge = (F.pmod("start", F.lit(block)) == 0) | (F.pmod("end", F.lit(block)) == 0)
    along = Window.partitionBy(*keys).orderBy("start")
    joined = (F.lag("end").over(along) == F.col("start")) & F.lag(flag).over(along).eqNullSafe(F.col(flag))
    edges = pieces.filter(at_edge).withColumn("_new", F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1))
    edges = edges.withColumn("_run", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    merged = edges.groupBy(*keys, "_run", flag).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    names = [*keys, flag, "start", "end"]
    return pieces.filter(~at_edge).select(*names).unionByName(merged.select(*names))


def keep_ranges(flags: DataFrame, keys: Sequence[str], order: str, *, least_idle: int = 7, least_kept: int = 16, trim: int = 10) -> DataFrame:
    """What stays when long idle runs are cut out: half-open ranges, their last ``trim`` frames cut off.

    Idle runs of at least ``least_idle`` frames go; of what is left, stretches of at least ``least_kept``
    frames stay. A range can be as short as ``least_kept - trim``.
    """
    single = runs(flags, keys, order, "idle").withColumn("gone", F.col("idle") & (F.col("end") - F.col("start") >= least_idle))
    # Neighbouring kept runs merge: again gaps and islands, over runs in place of frames.
    w = Window.partitionBy(*keys).orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    parted = single.withColumn("_part", F.sum(F.col("gone").cast("int")).over(w)).filter("not gone")
    kept = parted.groupBy(*keys, "_part").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_part")
    return kept.filter(F.col("end") - F.col("start") >= least_kept).withColumn("end", F.col("end") - trim)


def inside_ranges(df: DataFrame, ranges: DataFrame, keys: Sequence[str], order: str, width: int = 1024) -> DataFrame:
    """Frames that lie in some range of their key (a semi join over intervals).

    Ranges are cut into cells of ``width`` numbers, so that the join has an equality on key and cell
    and long recordings are spread.
    """
    cells = ranges.filter("end > start").withColumn("_cell", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width))))
    marked = df.withColumn("_cell", F.floor(F.col(order) / width))
    d, r = marked.alias("d"), cells.select(*keys, "_cell", "start", "end").alias("r")
    same = F.col("d._cell") == F.col("r._cell")
    for k in keys:
        same = same & (F.col(f"d.{k}") == F.col(f"r.{k}"))
    return d.join(r, same & (F.col(f"d.{order}") >= F.col("r.start")) & (F.col(f"d.{order}") < F.col("r.end")), "left_semi").drop("_cell")


def ranges_from_json(text: Column) -> Column:
    """A map of episode keys to half-open ranges."""
    return F.from_json(text, "map<string, array<array<int>>>")
