import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from reelgrain.functions.vectors import list_matrix, median_of_seven
from reelgrain.operators import spikes
from reelgrain.operators.spikes import implausible_readings

SCHEMA = "index bigint, episode_index bigint, frame_index bigint, source string, `observation.state` array<float>, action array<float>, block int, reason string"
RIGS = "source string, robot_type string, state_low array<float>, state_high array<float>, action_low array<float>, action_high array<float>"


def rigs(spark, rows=(("r", "t", [-9.0, -9.0, -1.0], [9.0, 9.0, 2.0], [-9.0], [9.0]),)):
    return spark.createDataFrame(list(rows), RIGS)


def recording(n=400, seed=1):
    """State: two smooth channels with noise and a two-position gripper; action: a held command."""
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    state = np.stack([np.sin(t / 20) + rng.normal(0, 0.002, n), np.cos(t / 30) * 2 + rng.normal(0, 0.002, n), (t // 50 % 2).astype(float)], axis=1)
    action = np.repeat(np.sin(np.arange(n // 10 + 1) / 3), 10)[:n, None]
    return state.astype(np.float32), action.astype(np.float32)


def frame_rows(state, action, episode=0, source="r", first=0):
    return [[first + i, episode, i, source, [float(x) for x in state[i]], [float(x) for x in action[i]], 7, "z"] for i in range(len(state))]


def found(spark, rows, **kw):
    out = implausible_readings(spark.createDataFrame(rows, SCHEMA), rigs(spark), **kw).collect()
    return {(r["index"], r["field_name"], r["dim"], r["reason"]) for r in out}


def test_planted(spark):
    state, action = recording(3000)
    state[100, 0] += 1.5
    state[200:203, 1] -= 2.0
    state[250:262, 0] = state[250, 0]
    state[300, 1], state[310, 0], action[50, 0] = 12.0, np.nan, np.inf
    state[320:326, 1] = state[320, 1]  # too short to be stuck
    state[2340:, 1] += 3.0  # a change that stays
    rows = frame_rows(state, action)
    rows += [list(r) for r in rows[95:105]]
    random.Random(2).shuffle(rows)
    got = found(spark, rows)
    s, a = "observation.state", "action"
    want = {(100, s, 0, "spike"), *((i, s, 1, "spike") for i in (200, 201, 202)), *((i, s, 0, "stuck") for i in range(250, 262)), (300, s, 1, "limit"), (310, s, 0, "limit"), (50, a, 0, "limit")}
    assert got == want


def test_blocks_give_the_same(spark, monkeypatch):
    state, action = recording(500, 4)
    state[123:126, 0] += 2
    state[124:140, 1] = state[124, 1]
    state[255:266, 0] = state[255, 0]
    rows = frame_rows(state, action)
    whole = found(spark, rows)
    monkeypatch.setattr(spikes, "BLOCK", 64)
    assert found(spark, rows) == whole and len(whole) == 3 + 16 + 11


def test_hard_rows(spark):
    state, action = recording(60)
    rows = frame_rows(state, action)
    rows[5][4] = None
    rows[6][4] = []
    rows[7][4] = [None, 50.0]
    rows[8][4] = [0.1, 0.2, 0.0, 99.0]  # a channel without limits
    rows[9][5] = None
    rows += [[1000, None, 3, "r", [50.0, 0.0, 0.0], [0.0], 1, ""], [1001, 4, None, "r", [0.0, 0.0, 0.0], [float("-inf")], 1, ""], [1002, 5, 0, None, [1e9], [1.0], 1, ""], [1003, 5, 1, None, [float("nan")], None, 1, ""], [None, 6, 0, "r", [99.0], [0.0], 1, ""], [1004, 7, -3, "unknown rig", [1e30], [1.0], 1, ""]]
    got = {g[:3] for g in found(spark, rows)}
    s = "observation.state"
    assert {(7, s, 1), (1000, s, 0), (1001, "action", 0), (1003, s, 0)} <= got
    assert not any(i in (5, 6, 9, None, 1002, 1004) for i, _, _ in got)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert implausible_readings(empty, rigs(spark)).count() == 0
    state, action = recording(30)
    frames = spark.createDataFrame(frame_rows(state, action), SCHEMA)
    assert implausible_readings(frames, rigs(spark).filter("false")).filter("reason = 'limit'").count() == 0


def test_hot_rig_and_second_rig(spark):
    rows = []
    for e in range(12):
        state, action = recording(100, e)
        state[40, 0] += 1.0
        rows += frame_rows(state, action, e, "r" if e < 10 else "q", 1000 * e)
    got = {g[:3] for g in found(spark, rows)}
    assert got == {(1000 * e + 40, "observation.state", 0) for e in range(12)}


def test_frozen_episode_at_any_partitioning(spark):
    """A channel that is stuck for most of a short episode is judged by its rig, however the frames are dealt out."""
    rows = []
    for e in range(12):
        state, action = recording(300 if e else 62, e)
        if not e:
            state[8:58, 0] = state[8, 0]
        rows += frame_rows(state, action, e, first=1000 * e)
    want = {(i, "observation.state", 0, "stuck") for i in range(8, 58)}
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (1, 200):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert found(spark, rows) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_spike_in_fast_episode(spark):
    """A departure beyond the rig's limit counts, however fast the episode moves that the task holds."""
    rng = np.random.default_rng(3)
    rows = []
    for e in range(41):
        n = 62 if not e else 400
        t = np.arange(n)
        state, action = recording(n, e)
        state[:, 0] = (t * 0.1 if not e else t * 0.002) + rng.normal(0, 0.0001, n)
        rows += frame_rows(state, action, e, first=1000 * e)
    rows[30][4][0] += 0.45
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (1, 200):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert (30, "observation.state", 0, "spike") in found(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_vectors():
    m, there = list_matrix(pa.array([[1.0, None], None, [3.0], []], pa.list_(pa.float32())))
    assert m.shape == (4, 2) and there.tolist() == [[True, False], [False, False], [True, False], [False, False]]
    parts = np.random.default_rng(0).normal(size=(7, 5, 3)).astype(np.float32)
    assert np.array_equal(median_of_seven(list(parts)), np.median(parts, axis=0))


def test_rates_over_whole_table(spark):
    """The limits part of the result against SQL over all frames."""
    root = "/root/testdata/sf0.001"
    frames, limits = spark.read.parquet(f"{root}/frames.parquet"), spark.read.parquet(f"{root}/rigs.parquet")
    got = {(r["index"], r["dim"]) for r in implausible_readings(frames, limits).filter("field_name = 'action' and reason = 'limit'").collect()}
    rows = frames.join(limits, "source").select("index", F.posexplode("action").alias("dim", "x"), "action_low", "action_high")
    bad = rows.filter("isnan(x) or abs(x) = float('inf') or x < action_low[dim] or x > action_high[dim]").select("index", "dim").distinct()
    assert got == {tuple(r) for r in bad.collect()}


def test_slices_of_rigs_give_the_same(spark):
    state, action = recording(600)
    state[100, 0] += 1.5
    rows = frame_rows(state, action) + frame_rows(state, action, 1, "q", 10_000) + frame_rows(state, action, 2, None, 20_000)
    assert found(spark, rows, slices=3) == found(spark, rows) != set()


def test_deviations_are_held_against_their_own_window():
    """Where a stretch is as wild as its departures they are none, however small the rig's moves."""
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (60, 1)).astype(np.float32)
    at = np.arange(60)
    one = spikes.examine(x, np.ones_like(x, bool), np.zeros(60, int), at > 0, np.full(1, -99, np.float32), np.full(1, 99, np.float32), 8)
    x[30] += 50
    two = spikes.examine(x, np.ones_like(x, bool), np.zeros(60, int), at > 0, np.full(1, -99, np.float32), np.full(1, 99, np.float32), 8)
    assert one["spread"].mean() > 0.2 and two["departure"][30] > 20 * two["spread"][30]
    assert np.flatnonzero(two["departure"][:, 0] > 12 * two["spread"][:, 0] + 5).tolist() == [30]
