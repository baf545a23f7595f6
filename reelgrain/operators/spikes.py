"""Implausible readings of frame vectors: impossible values, stuck stretches and spikes.

Two passes over the frames, grouped by episode. The first yields compact statistics of every
channel's frame-to-frame moves, which are merged per rig and channel. The second knows them and
judges the readings by the episode's own neighbourhood (a Hampel filter: departure from the rolling
median of seven frames against the median absolute deviation around it) and by what is normal on the
whole rig, never by the frames that a task happens to hold. Deviations are taken from the course, the
rolling median, so that a steady move is none. Only the statistics and the cases leave the passes;
frames are shuffled in each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgrain.functions.vectors import list_matrix, median_of_seven
from reelgrain.session import shuffle_partitions

FIELDS = ("observation.state", "action")
#: Frames of an episode that one group holds; longer episodes are cut, and HALO frames of the neighbours go along.
BLOCK, HALO = 4096, 8
#: The histogram of moves: bins per octave, and the exponent of its lowest edge.
PER_OCTAVE, LOWEST, BINS = 8, -40, 8 * 72
#: Moves to and from a reading that departs by so many times the median move of its neighbourhood don't count as usual ones.
CANDIDATE = 4.0
#: A median absolute deviation times this estimates a standard deviation.
NORMAL = 1.4826
OUT, STUCK, SPIKE = 0, 1, 2
STATS_SCHEMA = "source string, field int, payload binary"
SCHEMA = "kind int, field int, index bigint, dim int, departure float, top_move double"
#: Rigs are a small catalogue whose limits and usual moves every task needs; more are gone through in slices.
MAX_RIGS = 20_000


def _limits(rigs: DataFrame) -> dict[str, list[np.ndarray]]:
    rows = rigs.select("source", "state_low", "state_high", "action_low", "action_high").collect()
    low = lambda v: np.array([-np.inf if x is None else x for x in v or []], np.float32)
    high = lambda v: np.array([np.inf if x is None else x for x in v or []], np.float32)
    return {r[0]: [low(r[1]), high(r[2]), low(r[3]), high(r[4])] for r in rows if r[0] is not None}


def _bounds(limits: dict[str, list[np.ndarray]], source: str | None, field: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The limits of all channels; channels without one have none."""
    low, high = np.full(width, -np.inf, np.float32), np.full(width, np.inf, np.float32)
    if source in limits:
        a, b = limits[source][2 * field : 2 * field + 2]
        low[: len(a)], high[: len(b)] = a[:width], b[:width]
    return low, high


def _run_lengths(same: np.ndarray) -> np.ndarray:
    """For every cell, how many successive rows, itself included, are linked to it by ``same`` (row t with row t-1)."""
    n = len(same)
    at = np.arange(n, dtype=np.int32)[:, None]
    starts = np.maximum.accumulate(np.where(same, 0, at), axis=0)
    ends = np.where(np.vstack([~same[1:], np.ones((1, same.shape[1]), bool)]), at, np.int32(n))
    ends = np.minimum.accumulate(ends[::-1], axis=0)[::-1]
    return ends - starts + 1


def examine(x: np.ndarray, present: np.ndarray, segment: np.ndarray, linked: np.ndarray, low: np.ndarray, high: np.ndarray, min_run: int) -> dict:
    """Long stretches, departures and statistics of frames that lie in order.

    ``segment``: first row of each row's episode block. ``linked``: whether the row is the very next
    frame of the row before.
    """
    n, width = x.shape
    at = np.arange(n)
    out = present & ~(np.isfinite(x) & (x >= low) & (x <= high))
    good = present & ~out
    # Readings that can't be judged are replaced by the last good one of the episode, or the next.
    last = np.maximum.accumulate(np.where(good, at[:, None], -1), axis=0)
    stops = np.append(np.flatnonzero(segment[1:] != segment[:-1]), n - 1)
    end = stops[np.searchsorted(stops, at)]
    following = np.minimum.accumulate(np.where(good, at[:, None], n)[::-1], axis=0)[::-1]
    take = np.where(last >= segment[:, None], last, np.where(following <= end[:, None], following, -1))
    filled = np.where(take >= 0, np.take_along_axis(x, np.maximum(take, 0), axis=0), np.float32(0))
    first = np.minimum(np.maximum(at - 3, segment), np.maximum(end - 6, segment))
    course = median_of_seven([filled[np.minimum(first + k, end)] for k in range(7)])
    # At the ends of an episode the window lies to one side: there the course goes on by the usual step.
    ends = np.flatnonzero((at - 3 < segment) | (at + 3 > end))
    near = np.minimum(first[ends] + np.arange(7)[:, None], end[ends])
    window = filled[near]
    step = np.median(np.diff(window, axis=0), axis=0)
    course[ends] = np.median(window - step * (near - ends)[:, :, None], axis=0)
    residual = np.abs(filled - course)
    departure = np.where(good, residual, np.float32(0))
    # The median absolute deviation of the window: excursions of up to three of its seven frames don't raise it.
    # On a slope they bend the course of the frames after them, so of the windows around, behind and ahead the calmest counts.
    spread = median_of_seven([residual[np.minimum(first + k, end)] for k in range(7)]) * np.float32(NORMAL)
    spread = np.minimum(spread, np.minimum(spread[np.maximum(at - 3, segment)], spread[np.minimum(at + 3, end)]))

    pair = np.zeros((n, width), bool)
    pair[1:] = linked[1:, None] & good[1:] & good[:-1]
    move = np.zeros((n, width), np.float32)
    move[1:] = np.abs(filled[1:] - filled[:-1])
    same = pair & (move == 0)
    run = _run_lengths(same)
    long = (run >= min_run) & good
    moved = pair & (move > 0)
    middle = np.zeros(width, np.float32)
    for d in np.flatnonzero(moved.any(axis=0)):
        values = move[moved[:, d], d]
        middle[d] = np.partition(values, len(values) // 2)[len(values) // 2]
    wild = good & (departure > CANDIDATE * middle) & (departure > 0)
    calm = moved & ~wild
    calm[1:] &= ~wild[:-1]
    free = calm & ~long
    free[1:] &= ~long[:-1]
    pairs, held = pair.sum(axis=0), same.sum(axis=0)
    bins = np.zeros((n, width), np.int32)
    bins[calm] = np.clip(np.floor(np.log2(move[calm]) * PER_OCTAVE) - LOWEST * PER_OCTAVE, 0, BINS - 1)
    bins += np.arange(width, dtype=np.int32) * BINS
    counts = [np.bincount(bins[m], minlength=width * BINS).reshape(width, BINS) for m in (free, calm)]
    return {"out": out, "long": long, "departure": departure, "spread": spread, "pairs": pairs, "held": held, "counts": counts}


class Moves:
    """Mergeable statistics of the channels of one field on one rig."""

    def __init__(self, width: int) -> None:
        self.table = np.zeros((width, 2 + 2 * BINS), np.int64)

    def add(self, table: np.ndarray) -> None:
        if len(table) > len(self.table):
            self.table = np.vstack([self.table, np.zeros((len(table) - len(self.table), self.table.shape[1]), np.int64)])
        self.table[: len(table)] += table

    def pack(self) -> bytes:
        return zlib.compress(self.table.tobytes(), 1)

    @staticmethod
    def unpack(data: bytes) -> np.ndarray:
        return np.frombuffer(zlib.decompress(data), np.int64).reshape(-1, 2 + 2 * BINS)


def _normal(stats: DataFrame) -> dict[tuple[str | None, int], tuple[np.ndarray, np.ndarray]]:
    """By rig and field: which channels normally move, and their top moves."""
    rows = stats.limit(2 * MAX_RIGS + 1).collect()
    if len(rows) > 2 * MAX_RIGS:
        raise ValueError(f"frames of more than {MAX_RIGS} rigs at once; give more slices")
    return {(r["source"], r["field"]): (np.array(r["moving"], bool), np.array(r["top_move"], np.float64)) for r in rows}


def _pass(limits: dict[str, list[np.ndarray]], min_run: int, normal: dict | None = None, spike_factor: float = 0.0, deviations: float = 0.0):
    """The pass that yields statistics, or, where what is ``normal`` is known, the one that yields cases."""

    def batch(kind: int, field: int, index: np.ndarray, dim: np.ndarray, departure: np.ndarray, top: np.ndarray) -> pa.RecordBatch:
        n = len(index)
        columns = [pa.array(np.full(n, kind), pa.int32()), pa.array(np.full(n, field), pa.int32()), pa.array(index, pa.int64()), pa.array(dim, pa.int32()), pa.array(departure, pa.float32()), pa.array(top, pa.float64())]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "field", "index", "dim", "departure", "top_move"])

    def judge(rows: pa.Table, moves: dict) -> Iterator[pa.RecordBatch]:
        """Rows of one rig: whole episode blocks in order."""
        source = rows["source"][0].as_py()
        index = rows["index"].to_numpy()
        own = rows["own"].to_numpy()
        episode, frame, block = (rows[c].to_pandas().to_numpy(np.float64) for c in ("episode_index", "frame_index", "block"))
        again = np.zeros(len(index), bool)
        again[1:] = (index[1:] == index[:-1]) & (block[1:] == block[:-1])
        if again.any():
            keep = ~again
            rows = rows.filter(pa.array(keep))
            index, own, episode, frame, block = (a[keep] for a in (index, own, episode, frame, block))
        new = np.ones(len(index), bool)
        new[1:] = ~((episode[1:] == episode[:-1]) & (block[1:] == block[:-1]))
        segment = np.maximum.accumulate(np.where(new, np.arange(len(index)), 0))
        linked = np.zeros(len(index), bool)
        linked[1:] = ~new[1:] & (frame[1:] == frame[:-1] + 1)
        for field in range(2):
            x, present = list_matrix(rows["vector" + str(field)])
            width = x.shape[1]
            if not width:
                continue
            found = examine(x, present, segment, linked, *_bounds(limits, source, field, width), min_run)
            if normal is None:
                moves.setdefault((source, field), Moves(0)).add(np.hstack([found["pairs"][:, None], found["held"][:, None], *found["counts"]]))
                continue
            moving, top = (v[:width] for v in normal[source, field])
            cases = ((OUT, found["out"]), (STUCK, found["long"] & moving), (SPIKE, (found["departure"] > spike_factor * top) & (found["departure"] > deviations * found["spread"])))
            for kind, case in cases:
                at, dim = np.nonzero(case & own[:, None])
                if len(at):
                    yield batch(kind, field, index[at], dim, found["departure"][at, dim], top[dim])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves: dict = {}
        kept: list[pa.Table] = []
        size = 0

        def ready(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal kept, size
            if not kept:
                return
            rows = pa.concat_tables(kept).combine_chunks()
            source, episode, block = (rows[c].to_pandas() for c in ("source", "episode_index", "block"))
            rig = ((source != source.shift()) & ~(source.isna() & source.shift().isna())).to_numpy()
            cut = rig | (episode != episode.shift()).to_numpy() | (block != block.shift()).to_numpy()
            rig[0] = cut[0] = True
            stop = len(rows) if last else int(np.flatnonzero(cut)[-1])
            edges = [*np.flatnonzero(rig[:stop]), stop]
            for a, b in zip(edges, edges[1:]):
                if b > a:
                    yield from judge(rows.slice(a, b - a), moves)
            kept, size = ([rows.slice(stop)], len(rows) - stop) if stop < len(rows) else ([], 0)

        for b in batches:
            kept.append(pa.Table.from_batches([b]))
            size += b.num_rows
            if size >= 4 * BLOCK:
                yield from ready(False)
        yield from ready(True)
        for (source, field), m in moves.items():
            yield pa.RecordBatch.from_arrays([pa.array([source], pa.string()), pa.array([field], pa.int32()), pa.array([m.pack()], pa.binary())], names=["source", "field", "payload"])

    return run


def _merged_moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Statistics sorted by rig and field -> one row of each; only one sum is held at a time."""
    key, total = None, Moves(0)

    def closed() -> Iterator[pa.RecordBatch]:
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int32()), pa.array([total.pack()], pa.binary())], names=["source", "field", "payload"])

    for batch in batches:
        for source, field, payload in zip(*(batch.column(c).to_pylist() for c in ("source", "field", "payload"))):
            if (source, field) != key:
                yield from closed()
                key, total = (source, field), Moves(0)
            total.add(Moves.unpack(payload))
    yield from closed()


def _summed(stats: DataFrame, salts: int = 16) -> DataFrame:
    """One row per rig and field, in two steps: the statistics of all tasks are as many as tasks times rigs."""
    rows = stats.withColumn("_salt", F.pmod(F.xxhash64("payload"), F.lit(salts)))
    for keys in (["source", "field", "_salt"], ["source", "field"]):
        rows = rows.repartition(*keys).sortWithinPartitions("source", "field").select("source", "field", "payload").mapInArrow(_merged_moves, STATS_SCHEMA)
    return rows


def _usual(table: np.ndarray, quantile: float, held_share: float) -> tuple[list[bool], list[float]]:
    """Which channels normally move, and their top moves, by the statistics of one field on one rig."""
    movings, tops = [], []
    for row in table:
        pairs, held = row[:2]
        moving = bool(pairs > 0 and held < held_share * pairs)
        counts = row[2 : 2 + BINS] if moving and row[2 : 2 + BINS].any() else row[2 + BINS :]
        n = counts.sum()
        top = 0.0
        if n:
            k = int(np.searchsorted(np.cumsum(counts), np.ceil(quantile * n)))
            top = float(2.0 ** ((k + 1) / PER_OCTAVE + LOWEST))
        movings.append(moving)
        tops.append(top)
    return movings, tops


def _judged(quantile: float, held_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_usual(Moves.unpack(p), quantile, held_share) for p in batch.column("payload").to_pylist()]
            columns = [batch.column("source"), batch.column("field"), pa.array([m for m, _ in found], pa.list_(pa.bool_())), pa.array([t for _, t in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["source", "field", "moving", "top_move"])

    return run


def implausible_readings(
    frames: DataFrame,
    rigs: DataFrame,
    *,
    min_run: int = 8,
    spike_factor: float = 2.8,
    deviations: float = 3.0,
    quantile: float = 0.999,
    held_share: float = 0.35,
    slices: int = 0,
) -> DataFrame:
    """Every implausible reading with its reason: ``index``, ``field_name``, ``dim``, ``reason``.

    Reasons: ``limit`` (not finite, or outside the rig's limits), ``stuck`` (one of at least
    ``min_run`` successive frames with exactly equal readings, on a channel of which less than
    ``held_share`` of the readings equal their predecessor on that rig), ``spike`` (departs from the
    rolling median of seven frames by more than ``deviations`` times the scaled median absolute
    deviation of these frames from their course, and by more than ``spike_factor`` times the
    ``quantile`` of the channel's moves on that rig; the median follows a switch that stays and leaves excursions of up
    to three frames; at an episode's ends it is carried on by the usual step).

    Repeated rows (equal ``index``) count once. Null vectors, null elements and positions beyond a
    vector's end hold no reading. Frames without ``episode_index`` or ``frame_index`` have no
    neighbours and are judged by the limits alone; a rig that ``rigs`` doesn't hold has no limits, and
    frames without ``source`` form a rig of their own. More than ``MAX_RIGS`` rigs are gone through in
    ``slices`` by a hash of the source, each of which reads the frames of its rigs (0: as many as ``rigs``
    needs); a rig is judged by its own frames alone, so the result is the same. Rows without ``index`` are left out. Empty
    tables give an empty result; further columns are ignored.
    """
    spark = frames.sparkSession
    slices = slices or max(1, -(-rigs.count() // (MAX_RIGS // 2)))
    if slices > 1:
        mine = lambda df, i: df.filter(F.pmod(F.xxhash64("source"), F.lit(slices)) == i)
        each = (implausible_readings(mine(frames, i), mine(rigs, i), min_run=min_run, spike_factor=spike_factor, deviations=deviations, quantile=quantile, held_share=held_share, slices=1) for i in range(slices))
        return reduce(DataFrame.unionByName, each)
    lone = F.col("episode_index").isNull() | F.col("frame_index").isNull()
    at = F.expr(f"frame_index div {BLOCK}")
    near = F.array(at - 1, at, at + 1)
    inside = lambda b: (b >= 0) & F.col("frame_index").between(b * BLOCK - HALO, (b + 1) * BLOCK + HALO - 1)
    block = F.when(lone, F.array(-1 - F.abs(F.xxhash64("index") % (1 << 40)))).when(F.col("frame_index") < 0, F.array(at)).otherwise(F.filter(near, inside))
    rows = (
        frames.filter("index is not null")
        .select("index", "episode_index", "frame_index", "source", F.col("`observation.state`").alias("vector0"), F.col("action").alias("vector1"))
        .withColumn("block", F.explode(block))
        .withColumn("own", lone | (F.col("block") == at))
    )
    sorted_rows = rows.repartition(shuffle_partitions(spark), "episode_index", "block").sortWithinPartitions("source", "episode_index", "block", "frame_index", "index")
    known = _limits(rigs)
    stats = sorted_rows.mapInArrow(_pass(known, min_run), STATS_SCHEMA)
    normal = _normal(_summed(stats).mapInArrow(_judged(quantile, held_share), "source string, field int, moving array<boolean>, top_move array<double>"))
    found = sorted_rows.mapInArrow(_pass(known, min_run, normal, spike_factor, deviations), SCHEMA)
    field = F.when(F.col("field") == 0, FIELDS[0]).otherwise(FIELDS[1])
    reason = F.element_at(F.array(F.lit("limit"), F.lit("stuck"), F.lit("spike")), F.col("kind") + 1)
    return found.select("index", field.alias("field_name"), "dim", reason.alias("reason"), "departure", "top_move")
