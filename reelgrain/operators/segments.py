"""Recordings cut into segments, and annotations of segments: sessions, splits, samples, resuming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgrain.operators.chunks import last_in, ranged, total_in


def sessions(df: DataFrame, keys: Sequence[str], second: str, gap: int = 1) -> DataFrame:
    """Stretches whose successive seconds differ by at most ``gap``: ``start``, ``end`` (exclusive), ``n``."""
    rows = ranged(df.select(*keys, second).distinct(), keys, [second])
    rows = last_in(rows, keys, [second], F.col(second), "_was", before=True).withColumn("_new", F.coalesce(F.col(second) - F.col("_was") > gap, F.lit(True)).cast("int"))
    rows = total_in(rows, keys, [second], "_new", "_s").withColumn("_s", F.col("_s") + F.col("_new"))
    return rows.groupBy(*keys, "_s").agg(F.min(second).alias("start"), (F.max(second) + 1).alias("end"), F.count("*").alias("n")).drop("_s")


def listed(df: DataFrame, keys: Sequence[str], seconds: str, *, pairs: bool = True) -> DataFrame:
    """Segments of recordings that list their seconds in an array; those without any are left out.

    With ``pairs`` a list of two is one segment from the first to the second (exclusive).
    """
    size = F.coalesce(F.size(seconds), F.lit(0))
    pair = (size == 2) if pairs else F.lit(False)
    first, second = F.get(seconds, F.lit(0)), F.get(seconds, F.lit(1))
    given = df.filter(pair).select(*keys, first.alias("start"), second.alias("end"))
    each = df.filter((size > 0) & ~pair).select(*keys, F.explode(seconds).alias("_second"))
    return given.unionByName(sessions(each, keys, "_second").select(*keys, "start", "end"))


def split_long(segments: DataFrame, longest: int) -> DataFrame:
    """Segments longer than ``longest`` in two halves, cut at the middle (rounded down)."""
    middle = F.floor((F.col("start") + F.col("end")) / 2).cast(segments.schema["start"].dataType)
    piece = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    long = F.col("end") - F.col("start") > longest
    pieces = F.when(long, F.array(piece(F.col("start"), middle), piece(middle, F.col("end")))).otherwise(F.array(piece(F.col("start"), F.col("end"))))
    rest = [c for c in segments.columns if c not in ("start", "end")]
    return segments.select(*rest, F.explode(pieces).alias("_p")).select(*rest, "_p.start", "_p.end")


def frame_bounds(start: Column, end: Column, fps: Column, frames: Column) -> tuple[Column, Column]:
    """First and last (exclusive) frame of a segment, inside the recording."""
    return F.greatest(F.lit(0), (start * fps).cast("bigint")), F.least(frames, (end * fps).cast("bigint"))


def second_triples(videos: DataFrame, keys: Sequence[str], frames: str, per_second: int = 30) -> DataFrame:
    """Start, middle and end frame of each whole second; a second whose end is not in the video is left out."""
    last = F.floor((F.col(frames) - 1 - per_second) / per_second).cast("bigint")
    rows = videos.filter(F.col(frames) > per_second).select(*keys, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("second"))
    at = F.col("second") * per_second
    return rows.select(*keys, "second", F.array(at, at + per_second // 2, at + per_second).alias("frame_indices"))


def frame_chunks(videos: DataFrame, keys: Sequence[str], frames: str, size: int, fps: str | None = None) -> DataFrame:
    """``chunk``, ``start``, ``end`` of pieces of ``size`` frames, the last one shorter; and ``at``, its time."""
    count = F.ceil(F.col(frames) / size).cast("bigint")
    rows = videos.filter(F.col(frames) > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)))
    start = F.col("chunk") * size
    out = [*keys, "chunk", start.alias("start"), F.least(start + size, F.col(frames)).alias("end")]
    return rows.select(*out, *([(start / F.col(fps)).alias("at")] if fps else []))


def per_second(chunks: DataFrame, key: str, start: str, notes: str, order: Sequence[str]) -> DataFrame:
    """Notes of each second of annotated chunks at their place in the video.

    Of chunks with one start the first by ``order`` counts.
    """
    w = Window.partitionBy(key, start).orderBy(*order)
    first = chunks.withColumn("_n", F.row_number().over(w)).filter("_n = 1")
    return first.select(key, start, F.posexplode(notes).alias("_i", "note")).select(key, (F.col(start) + F.col("_i")).cast("bigint").alias("second"), "note")


def collected(lines: DataFrame, key: str, order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The lines of each key as one sorted array. Its size is that of the key's annotations."""
    return lines.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *[f for f in fields if f not in order]))).alias("segments"))


def outstanding(tasks: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tasks that no finished line covers."""
    return tasks.join(done.select(*keys).distinct(), list(keys), "left_anti")


def key_ranges(lines: DataFrame, text: str = "value") -> DataFrame:
    """Lines like ``a-b,c:info`` as one row per number: ``line``, ``number``, ``info``.

    Numbers may be bare or named, as in ``episode_000010-episode_000020``. Blank lines, those that
    start with ``#`` and those without a colon are skipped; a reversed range is turned round.
    """
    rows = lines.filter(~F.trim(text).rlike("^(#|$)") & F.contains(F.col(text), F.lit(":"))).withColumn("_keys", F.trim(F.split_part(text, F.lit(":"), F.lit(1)))).withColumn("info", F.trim(F.regexp_replace(text, "^[^:]*:", "")))
    one = r"(?:episode_)?(\d+)"
    part = rows.select("line", "info", F.explode(F.split("_keys", ",")).alias("_k")).withColumn("_k", F.trim("_k")).filter(F.col("_k").rlike(rf"^{one}(?:\s*-\s*{one})?$"))
    a, b = F.regexp_extract("_k", rf"^{one}", 1).cast("bigint"), F.regexp_extract("_k", rf"{one}$", 1).cast("bigint")
    return part.select("line", "info", F.explode(F.sequence(F.least(a, b), F.greatest(a, b))).alias("number"))


def range_info(ranges: DataFrame) -> DataFrame:
    """Each number's info; where lines overlap the last one wins."""
    return ranges.groupBy("number").agg(F.max_by("info", "line").alias("info"))


def progress(done: DataFrame, target: str = "target", n: str = "n") -> DataFrame:
    """How many tasks are complete, and how many have begun."""
    return done.agg(F.count_if((F.col(n) == F.col(target)) & (F.col(target) > 0)).alias("complete"), F.count_if(F.col(n) > 0).alias("begun"), F.sum(n).cast("bigint").alias("pieces"))


def with_frames(chunks: DataFrame, frames: str, least: int = 3) -> tuple[DataFrame, DataFrame]:
    """Chunks of at least so many frames, and an error row for each of the others."""
    enough = F.coalesce(F.size(frames), F.lit(0)) >= least
    return chunks.filter(enough), chunks.filter(~enough).withColumn("error", F.format_string("%d of at least %d frames", F.coalesce(F.size(frames), F.lit(0)), F.lit(least)))


def moving(steps: DataFrame, enabled: str) -> DataFrame:
    """Steps whose movement isn't disabled; where nothing is told it is enabled."""
    return steps.filter(F.coalesce(F.col(enabled), F.lit(True)))


def cameras_of(cameras: Column, wrist: bool) -> Column:
    """The cameras on the wrist (type 0), or those elsewhere, of an array of structs with ``type``."""
    return F.filter(cameras, lambda c: (c["type"] == 0) if wrist else (c["type"] != 0))
