"""Mergeable percentiles of vector channels with multiplicative rank error at both tails.

The sketch is a relative-rank compactor: each level is a buffer of which the half next to the
protected tail is never touched, while of the other half more or fewer sections are compacted, every
other item moving up to a level of twice the weight. The rank of an item at distance R from the
protected tail is then off by at most a small share of R. A level gets one more section whenever the
number of its compactions doubles, so that the share doesn't grow with the number of readings. Each
channel has one sketch for the low tail and one for the high tail (the same on negated values).
Sketches of partitions, days and rigs are merged level by level.

Frames are shuffled once, to slices of their source. A slice holds whole days; only a day that is
larger than a slice is cut. Its task sketches each day and, of the days' sketches, the slice, so that
sources and robot types are merged from one sketch a slice.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgrain.functions.vectors import list_matrix
from reelgrain.session import materialize, shuffle_partitions

FIELDS = ("observation.state", "action")
#: Items of a section, and sections of the compactable half at the start: a level of few compactions holds up
#: to 2 * SECTION * SECTIONS items.
SECTION, SECTIONS = 32, 6
#: Frames of a slice.
SLICE = 50_000
#: Slices whose sketches are merged in one step.
FAN = 256
#: Stated bound: the rank of a percentile q is off by at most this share of min(q, 1 - q) * n; up to
#: 2 * SECTION * SECTIONS readings it is exact. Measured errors are below a quarter of it, whatever the
#: order of the readings and the number of sketches merged (tests hold them against it).
RANK_ERROR = 0.01
PERCENTILES = (0.01, 0.25, 0.5, 0.75, 0.9, 0.99)


class TailSketch:
    """Sketches of many channels at once, all protecting the low tail. NaN is no reading."""

    def __init__(self, width: int, seed: int = 1) -> None:
        self.levels: list[np.ndarray] = [np.empty((0, width), np.float32)]
        self.turns: list[int] = [0]
        self.random = np.random.default_rng(seed)

    def add(self, x: np.ndarray, level: int = 0) -> None:
        while len(self.levels) <= level:
            self.levels.append(np.empty((0, x.shape[1]), np.float32))
            self.turns.append(0)
        self.levels[level] = np.concatenate([self.levels[level], x])

    def compress(self) -> None:
        """Compact every level that holds more than its capacity, from the lowest up."""
        level = 0
        while level < len(self.levels):
            rows, turn = self.levels[level], self.turns[level]
            room = max(SECTIONS, turn.bit_length() + 1)
            capacity = 2 * SECTION * room
            if len(rows) > capacity:
                sections = min(room, (~turn & (turn + 1)).bit_length())
                keep = capacity - sections * SECTION
                keep += (len(rows) - keep) % 2
                rows = np.sort(rows, axis=0)
                self.levels[level], self.turns[level] = rows[:keep], turn + 1
                self.add(rows[keep + int(self.random.integers(2)) :: 2], level + 1)
            level += 1


def pack(n: np.ndarray, tails: Sequence[TailSketch]) -> bytes:
    """The sketches of all channels of a field: their readings, then both tails' levels with their turns.

    As long as nothing was compacted both tails hold the same readings, which are then kept once.
    """
    once = all(len(t.levels) == 1 for t in tails)
    parts = [struct.pack("<ii", len(n), once), n.astype("<i8").tobytes()]
    for tail in tails[:1] if once else tails:
        parts.append(struct.pack(f"<i{2 * len(tail.levels)}q", len(tail.levels), *(x for v, t in zip(tail.levels, tail.turns) for x in (len(v), t))))
        parts += [np.ascontiguousarray(v, np.float32).tobytes() for v in tail.levels]
    return b"".join(parts)


def unpack(data: bytes) -> tuple[np.ndarray, list[TailSketch]]:
    width, once = struct.unpack_from("<ii", data)
    n, at, tails = np.frombuffer(data, np.int64, width, 8), 8 + 8 * width, []
    for side in range(1 if once else 2):
        tail = TailSketch(width, side + 1)
        (count,) = struct.unpack_from("<i", data, at)
        header = struct.unpack_from(f"<{2 * count}q", data, at + 4)
        at += 4 + 16 * count
        tail.levels, tail.turns = [], list(header[1::2])
        for size in header[::2]:
            tail.levels.append(np.frombuffer(data, np.float32, size * width, at).reshape(size, width))
            at += 4 * size * width
        tails.append(tail)
    if once:
        tails.append(TailSketch(width, 2))
        tails[1].levels = [-tails[0].levels[0]]
    return n, tails


def _widen(n: np.ndarray, tails: Sequence[TailSketch], width: int) -> np.ndarray:
    """Room for further channels, which have no readings yet."""
    more = width - len(n)
    if more:
        for tail in tails:
            tail.levels = [np.pad(v, ((0, 0), (0, more)), constant_values=np.nan) for v in tail.levels]
    return np.pad(n, (0, more))


def merge(sketches: Sequence[bytes]) -> bytes:
    """The sketch of all readings."""
    if len(sketches) == 1:
        return sketches[0]
    opened = [unpack(s) for s in sketches]
    width = max(len(n) for n, _ in opened)
    readings = sum(_widen(n, tails, width) for n, tails in opened)
    out = []
    for side in range(2):
        total, held = TailSketch(width, len(opened)), [tails[side] for _, tails in opened]
        for level in range(max(len(t.levels) for t in held)):
            here = [t for t in held if len(t.levels) > level]
            total.add(np.concatenate([t.levels[level] for t in here]), level)
            total.turns[level] = int(np.bitwise_or.reduce([t.turns[level] for t in here]))
        total.compress()
        out.append(total)
    return pack(readings, out)


def percentiles(sketch: bytes, wanted: Sequence[float] = PERCENTILES) -> tuple[np.ndarray, np.ndarray]:
    """Readings of each channel, and by channel the smallest reading at or below which each share lies.

    Each share is looked up from the tail that is nearer; channels without readings give NaN.
    """
    n, tails = unpack(sketch)
    out = np.full((len(n), len(wanted)), np.nan)
    for side, tail in enumerate(tails):
        values = np.concatenate(tail.levels)
        if not len(values):
            continue
        weights = np.concatenate([np.full(len(v), 1 << i, np.int64) for i, v in enumerate(tail.levels)])
        order = np.argsort(values, axis=0, kind="stable")
        values, below = np.take_along_axis(values, order, axis=0), np.cumsum(weights[order], axis=0)
        last = np.maximum((~np.isnan(values)).sum(axis=0) - 1, 0)
        for k, q in enumerate(wanted):
            if (q <= 0.5) == (side == 0):
                rank = np.clip(np.ceil(q * n - 1e-9), 1, np.maximum(n, 1)).astype(np.int64)
                at = np.minimum((below < (rank if side == 0 else n - rank + 1)).sum(axis=0), last)
                out[:, k] = np.take_along_axis(values, at[None, :], axis=0)[0] * (1 if side == 0 else -1)
    return n, out


def _groups(batches: Iterator[pa.RecordBatch], by: Sequence[str]) -> Iterator[tuple[tuple, dict[int, bytes]]]:
    """Rows sorted by group and index -> each group with the sketches of its fields."""
    group: tuple | None = None
    last: int | None = None
    held: dict[int, list] = {}

    def closed() -> dict[int, bytes]:
        for n, *tails in held.values():
            for tail in tails:
                tail.compress()
        out = {field: pack(n, tails) for field, (n, *tails) in held.items()}
        held.clear()
        return out

    for batch in batches:
        keys = [batch.column(b) for b in by]
        index = batch.column("index").to_numpy(zero_copy_only=False)
        frame = pd.DataFrame({i: k.to_pandas() for i, k in enumerate(keys)})
        shifted = frame.shift()
        new = ~((frame == shifted) | (frame.isna() & shifted.isna())).all(axis=1).to_numpy()
        new[0] = True
        again = np.zeros(len(index), bool)
        again[1:] = (index[1:] == index[:-1]) & ~new[1:]
        edges = [*np.flatnonzero(new), len(index)]
        for a, b in zip(edges, edges[1:]):
            key = tuple(k[int(a)].as_py() for k in keys)
            if key != group:
                if group is not None:
                    yield group, closed()
                group, last = key, None
            keep = ~again[a:b]
            keep[0] = keep[0] and index[a] != last
            last = index[b - 1]
            for field in range(2):
                x, present = list_matrix(batch.column(f"vector{field}").slice(a, b - a))
                x, present = x[keep], present[keep]
                if not x.size:
                    continue
                x = np.where(present & np.isfinite(x), x, np.float32("nan"))
                own = held.get(field)
                if own is None:
                    own = held[field] = [np.zeros(x.shape[1], np.int64), TailSketch(x.shape[1], 1), TailSketch(x.shape[1], 2)]
                if x.shape[1] < len(own[0]):
                    x = np.pad(x, ((0, 0), (0, len(own[0]) - x.shape[1])), constant_values=np.nan)
                elif x.shape[1] > len(own[0]):
                    own[0] = _widen(own[0], own[1:], x.shape[1])
                own[0] += (~np.isnan(x)).sum(axis=0)
                for tail, sign in zip(own[1:], (1, -1)):
                    tail.add(x if sign > 0 else -x)
                    tail.compress()
    if group is not None:
        yield group, closed()


class _Sum:
    """Sketches that come one after the other, merged so many at a time."""

    def __init__(self, at_once: int = 32) -> None:
        self.at_once, self.held = at_once, []

    def add(self, sketch: bytes) -> None:
        self.held.append(sketch)
        if len(self.held) >= self.at_once:
            self.held = [merge(self.held)]

    def close(self) -> bytes:
        out = merge(self.held)
        self.held = []
        return out


_KEYS = "n array<bigint>, " + ", ".join(f"p{round(100 * q):02d} array<double>" for q in PERCENTILES)
_ANSWER_TYPES = [pa.list_(pa.int64()), *[pa.list_(pa.float64())] * len(PERCENTILES)]
_NAMES = ["n", *(f"p{round(100 * q):02d}" for q in PERCENTILES)]


def _kinds(by: Sequence[str]) -> str:
    return "".join(f"{b} string, " for b in by)


def _answered(sketch: bytes) -> list:
    n, found = percentiles(sketch)
    return [n, *(found[:, k] for k in range(len(PERCENTILES)))]


def _batch(by: Sequence[str], rows: Sequence[tuple]) -> pa.RecordBatch:
    """Rows of key, field, sketch (or None) and answers (or None)."""
    keys = [pa.array([r[0][i] for r in rows], pa.string()) for i in range(len(by))]
    told = [pa.array([r[3][i] if r[3] is not None else None for r in rows], t) for i, t in enumerate(_ANSWER_TYPES)]
    return pa.RecordBatch.from_arrays([*keys, pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary()), *told], names=[*by, "field", "sketch", *_NAMES])


def _fold(by: Sequence[str], answered: bool):
    """Sketches sorted by group and field -> one of each, with its answers if they are wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, total = None, _Sum()

        def closed() -> Iterator[pa.RecordBatch]:
            if group is not None:
                sketch = total.close()
                yield _batch(by, [(group[:-1], group[-1], sketch, _answered(sketch) if answered else None)])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*by, "field")]
            for i, *key in zip(range(batch.num_rows), *columns):
                if tuple(key) != group:
                    yield from closed()
                    group = tuple(key)
                total.add(batch.column("sketch")[i].as_py())
        yield from closed()

    return run


def _merged(sketches: DataFrame, by: Sequence[str], order: Column) -> DataFrame:
    """Sketches of one group and field become one, ``FAN`` neighbours by ``order`` (a number) first.

    Beside the sketch stand its answers, so that none has to be moved again to be asked. Only one sum
    and a few sketches are held at a time.
    """
    rows = sketches.select(*by, "field", "sketch", order.cast("bigint").alias("_order"))
    rows = rows.withColumn("_fan", F.expr(f"cast(_order div {FAN} as string)"))
    rows = rows.repartition(*by, "field", "_fan").sortWithinPartitions(*by, "field", "_fan", "_order").select(*by, "_fan", "field", "sketch")
    rows = rows.mapInArrow(_fold([*by, "_fan"], False), f"{_kinds([*by, '_fan'])}field int, sketch binary, {_KEYS}")
    rows = rows.repartition(*by, "field").sortWithinPartitions(*by, "field", "_fan").select(*by, "field", "sketch")
    return rows.mapInArrow(_fold(by, True), f"{_kinds(by)}field int, sketch binary, {_KEYS}")


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by source, slice, day and index -> a sketch of each day, and one of each slice with no day.

    Days that are whole in their slice come out as their answers.
    """
    at, totals = None, {}
    by = ["scope", "source", "slice", "day"]

    def closed() -> Iterator[pa.RecordBatch]:
        if totals:
            yield _batch(by, [(("slice", *at, None), field, total.close(), None) for field, total in totals.items()])
            totals.clear()

    for (source, part, day, whole), sketches in _groups(batches, ("source", "slice", "day", "whole")):
        if (source, part) != at:
            yield from closed()
            at = (source, part)
        rows = []
        for field, sketch in sketches.items():
            totals.setdefault(field, _Sum()).add(sketch)
            rows.append((("day" if whole == "1" else "piece", source, part, day), field, None if whole == "1" else sketch, _answered(sketch) if whole == "1" else None))
        if rows:
            yield _batch(by, rows)
    yield from closed()


def _placed(frames: DataFrame, by: Sequence[str]) -> DataFrame:
    """Frames with the number of ``pieces`` that their group is cut into, and of ``slices`` of their first key."""
    sizes = materialize(frames.groupBy(*by).agg(F.count("*").alias("_n")))
    known = {b: f"_k{i}" for i, b in enumerate(by)}
    same = lambda names: reduce(lambda a, b: a & b, (F.col(n).eqNullSafe(F.col(k)) for n, k in names.items()))
    firsts = sizes.groupBy(F.col(by[0]).alias("_f")).agg(F.ceil(F.sum("_n") / SLICE).alias("slices"))
    groups = sizes.join(firsts, F.col(by[0]).eqNullSafe(F.col("_f"))).select(*(F.col(b).alias(k) for b, k in known.items()), F.ceil(F.col("_n") / SLICE).alias("pieces"), "slices")
    if sizes.limit(MAX_DAYS_SENT + 1).count() <= MAX_DAYS_SENT:
        groups = F.broadcast(groups)
    return frames.join(groups, same(known)).drop(*known.values())


def _vectors(frames: DataFrame, by: Sequence[str]) -> DataFrame:
    return frames.filter("index is not null").select(*by, "index", F.col("`observation.state`").alias("vector0"), F.col("action").alias("vector1"))


def channel_sketches(frames: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group and field: ``by``, ``field``, ``sketch``, which holds all channels, and its answers.

    ``by`` names string columns; null is a group of its own. A group of more than ``SLICE`` frames is
    cut by their index, so a group may hold any share of all rows. Repeated rows (equal ``index``)
    count once, rows without index are left out, null vectors, null elements and non-finite readings
    are none; vectors of one group may differ in length. An empty table gives an empty result.
    """
    rows = _placed(_vectors(frames, by), by).withColumn("_piece", F.pmod(F.xxhash64("index"), F.col("pieces")).cast("string"))
    ordered = rows.select(*by, "_piece", "index", "vector0", "vector1").repartition(shuffle_partitions(frames.sparkSession), *by, "_piece").sortWithinPartitions(*by, "_piece", "index")

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, sketches in _groups(batches, [*by, "_piece"]):
            if sketches:
                yield _batch([*by, "_piece"], [(key, field, sketch, None) for field, sketch in sketches.items()])

    parts = ordered.mapInArrow(sketched, f"{_kinds([*by, '_piece'])}field int, sketch binary, {_KEYS}")
    return _merged(parts, by, F.col("_piece"))


def answers(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """The percentiles beside merged sketches as columns, one row per group, field and channel.

    ``rank_error`` is the stated bound, as a share of min(q, 1 - q) * n.
    """
    rows = sketches.select(*by, "field", F.posexplode(F.arrays_zip(*_NAMES)).alias("dim", "a"))
    field = F.when(F.col("field") == 0, FIELDS[0]).otherwise(FIELDS[1]).alias("field_name")
    known = [F.when(~F.isnan(f"a.{c}"), F.col(f"a.{c}")).alias(c) for c in _NAMES[1:]]
    return rows.select(*by, field, "dim", "a.n", *known, F.lit(RANK_ERROR).alias("rank_error"))


#: So many episodes' days, or sizes of groups, are sent to every task (about 20 MB); more are joined by a shuffle.
MAX_DAYS_SENT = 500_000


def with_day(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Frames with the ``day`` on which their episode was recorded, null where that is not known."""
    days = episodes.filter("episode_index is not null").groupBy("episode_index").agg(F.date_format(F.min("recorded_at"), "yyyy-MM-dd").alias("day"))
    if episodes.select("episode_index").limit(MAX_DAYS_SENT + 1).count() <= MAX_DAYS_SENT:
        days = F.broadcast(days)
    return frames.select("index", "episode_index", "source", "`observation.state`", "action").join(days, "episode_index", "left")


def daily_sketches(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Sketches of single days per source; any of them can be merged later."""
    return channel_sketches(with_day(frames, episodes), ["source", "day"])


def all_percentiles(frames: DataFrame, episodes: DataFrame, rigs: DataFrame) -> DataFrame:
    """Percentiles of every channel per source and day, per source, and per robot type.

    The frames are read once for their counts and once for the sketches of days and slices; those of
    sources are merged from the slices, and those of robot types from these. ``scope`` names the
    level, ``name`` the source or robot type, ``day`` the day, null in the wider scopes and where the
    episode's day is not known. Sources that ``rigs`` doesn't hold have a null robot type. Channels
    without finite readings have n = 0 and no percentiles. An empty table gives an empty result.
    The answers depend on the rows alone, not on how they are partitioned.
    """
    rows = _placed(_vectors(with_day(frames, episodes), ["source", "day"]), ["source", "day"])
    place = F.pmod(F.xxhash64("day", F.pmod(F.xxhash64("index"), F.col("pieces"))), F.col("slices"))
    rows = rows.select("source", place.cast("string").alias("slice"), "day", (F.col("pieces") == 1).cast("int").cast("string").alias("whole"), "index", "vector0", "vector1")
    ordered = rows.repartition(shuffle_partitions(frames.sparkSession), "source", "slice").sortWithinPartitions("source", "slice", "day", "index")
    found = materialize(ordered.mapInArrow(_sliced, f"{_kinds(['scope', 'source', 'slice', 'day'])}field int, sketch binary, {_KEYS}"))
    cut = _merged(found.filter("scope = 'piece'"), ["source", "day"], F.col("slice"))
    by_source = materialize(_merged(found.filter("scope = 'slice'"), ["source"], F.col("slice")))
    types = rigs.filter("source is not null").groupBy("source").agg(F.min("robot_type").alias("robot_type"))
    by_type = _merged(by_source.join(types, "source", "left"), ["robot_type"], F.pmod(F.xxhash64("source"), F.lit(FAN * FAN)))
    day = answers(found.filter("scope = 'day'"), ["source", "day"]).unionByName(answers(cut, ["source", "day"])).withColumnRenamed("source", "name").withColumn("scope", F.lit("source_day"))
    source = answers(by_source, ["source"]).withColumnRenamed("source", "name").withColumn("scope", F.lit("source"))
    kind = answers(by_type, ["robot_type"]).withColumnRenamed("robot_type", "name").withColumn("scope", F.lit("robot_type"))
    return day.unionByName(source, allowMissingColumns=True).unionByName(kind, allowMissingColumns=True)


def within_bound(frames: DataFrame, found: DataFrame) -> DataFrame:
    """Per source, field and channel the readings and whether all percentiles keep the stated bound, by counting.

    ``found`` is the result of :func:`all_percentiles`. A percentile keeps it if the wanted rank, moved by
    at most ``rank_error`` times min(q, 1 - q) * n, lies among the ranks of readings equal to it.
    """
    told = found.filter("scope = 'source'").select(F.col("name").alias("_s"), F.col("field_name").alias("_f"), F.col("dim").alias("_d"), "n", "rank_error", *_NAMES[1:])
    rows = frames.filter("index is not null").select("index", "source", "`observation.state`", "action").dropDuplicates(["index"])
    each = rows.select("source", F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f"`{f}`").alias("v")) for f in FIELDS))).alias("f"))
    each = each.select("source", "f.field_name", F.posexplode("f.v").alias("dim", "x")).filter("abs(x) < float('Infinity')")
    beside = each.join(F.broadcast(told), F.col("source").eqNullSafe(F.col("_s")) & (F.col("field_name") == F.col("_f")) & (F.col("dim") == F.col("_d")))
    x = F.col("x").cast("double")
    counts = [c for name in _NAMES[1:] for c in (F.count_if(x < F.col(name)).alias(f"_b{name}"), F.count_if(x == F.col(name)).alias(f"_e{name}"))]
    sums = beside.groupBy("source", "field_name", "dim", "n", "rank_error").agg(F.count("*").alias("counted"), *counts)
    kept = F.col("n") == F.col("counted")
    for q, name in zip(PERCENTILES, _NAMES[1:]):
        rank, slack = F.ceil(F.lit(q) * F.col("n") - 1e-9), F.col("rank_error") * min(q, 1 - q) * F.col("n")
        kept = kept & (F.col(f"_e{name}") > 0) & (F.col(f"_b{name}") + 1 - slack <= rank) & (F.col(f"_b{name}") + F.col(f"_e{name}") + slack >= rank)
    return sums.select("source", "field_name", F.col("dim").cast("bigint").alias("dim"), "n", kept.alias("kept"))
