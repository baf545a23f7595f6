"""Ordered operators against plain loops on small and hard tables."""

import random

import pytest
from pyspark.sql import functions as F

from reelgrain.operators import brokers, chunks, datasets, idle, retrieval, sampling, segments


def series(spark, n=50, keys=("a", "b"), seed=1):
    r = random.Random(seed)
    rows = [(k, i, float(r.randrange(9))) for k in keys for i in range(n if k == "a" else n // 5)]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t bigint, v double")


def test_chunks_across_blocks(spark, monkeypatch):
    df = series(spark)
    by = {k: [r["v"] for r in sorted((r for r in df.collect() if r["k"] == k), key=lambda r: r["t"])] for k in "ab"}
    for block in (8192, 7):
        monkeypatch.setattr(chunks, "BLOCK", block)
        monkeypatch.setattr(chunks.blocked, "__defaults__", (block,))
        for r in chunks.action_chunk(df, ["k"], "t", "v", 4).collect():
            v = by[r["k"]][r["t"] : r["t"] + 4]
            assert r["chunk"] == v + [v[-1]] * (4 - len(v)) and r["real"] == len(v)
        for r in chunks.delta_query(df, ["k"], "t", "v", [-2, 0, 3]).collect():
            v, at = by[r["k"]], r["t"] + r["delta"]
            assert r["looked"] == v[max(0, min(len(v) - 1, at))] and r["is_pad"] == (not 0 <= at < len(v))


def test_nulls_in_chunks(spark):
    df = spark.createDataFrame([("a", 0, None), ("a", 1, 2.0), ("a", 2, None)], "k string, t bigint, v double")
    got = {r["t"]: r["chunk"] for r in chunks.action_chunk(df, ["k"], "t", "v", 2).collect()}
    assert got == {0: [None, 2.0], 1: [2.0, None], 2: [None, None]}
    looked = {(r["t"], r["delta"]): (r["looked"], r["is_pad"]) for r in chunks.delta_query(df, ["k"], "t", "v", [1]).collect()}
    assert looked == {(0, 1): (2.0, False), (1, 1): (None, False), (2, 1): (None, True)}


def test_running_total(spark):
    df = spark.createDataFrame([(i, (i * 7) % 5) for i in range(200)], "i bigint, x bigint").repartition(5)
    got = {r["i"]: r["s"] for r in chunks.running_total(df, ["i"], "x", "s", partitions=6).collect()}
    assert got == {i: sum((j * 7) % 5 for j in range(i)) for i in range(200)}
    assert chunks.running_total(df.filter("false"), ["i"], "x", "s").count() == 0


def test_keep_ranges(spark):
    r = random.Random(3)
    flags = []
    while len(flags) < 600:
        flags += [r.random() < 0.5] * r.choice([1, 2, 6, 7, 8, 15, 16, 17, 30])
    df = spark.createDataFrame([("a", i, f) for i, f in enumerate(flags)], "k string, t bigint, idle boolean")
    got = sorted((x["start"], x["end"]) for x in idle.keep_ranges(df, ["k"], "t").collect())
    keep, i = [True] * len(flags), 0
    while i < len(flags):
        j = i
        while j < len(flags) and flags[j] == flags[i]:
            j += 1
        if flags[i] and j - i >= 7:
            keep[i:j] = [False] * (j - i)
        i = j
    want, i = [], 0
    while i < len(keep):
        j = i
        while j < len(keep) and keep[j] == keep[i]:
            j += 1
        if keep[i] and j - i >= 16:
            want.append((i, j - 10))
        i = j
    assert got == want and len(want) > 3
    inside = {x["t"] for x in idle.inside_ranges(df.select("k", "t"), idle.keep_ranges(df, ["k"], "t"), ["k"], "t", 16).collect()}
    assert inside == {t for a, b in want for t in range(a, b)}


def test_runs_across_blocks(spark):
    r = random.Random(9)
    flags = [r.choice([True, False, None]) if r.random() < 0.2 else True for _ in range(150)]
    df = spark.createDataFrame([(k, i, f) for k in "ab" for i, f in enumerate(flags) if i % 40 != 39], "k string, t bigint, idle boolean")
    whole = sorted(map(str, idle.runs(df, ["k"], "t", "idle").collect()))
    for block in (4, 10, 40):
        assert sorted(map(str, idle.runs(df, ["k"], "t", "idle", block).collect())) == whole
    assert idle.runs(df.filter("false"), ["k"], "t", "idle").count() == 0


def test_idle_flags(spark):
    df = spark.createDataFrame([("a", 0, [1.0, 2.0]), ("a", 1, [1.0, 2.0]), ("a", 2, [1.0, 2.5]), ("a", 3, None), ("a", 4, [1.0, 2.5]), ("a", 5, [float("nan"), 2.5])], "k string, t bigint, v array<double>")
    assert [r["idle"] for r in idle.idle_flags(df, ["k"], "t", "v").orderBy("t").collect()] == [False, True, False, False, False, False]


def test_datasets(spark):
    a, b = spark.createDataFrame([(1, "x", 2.0)], "id int, name string, extra double"), spark.createDataFrame([(5, "y")], "id int, name string")
    assert [tuple(r) for r in datasets.union_common([a, b]).orderBy("id").collect()] == [(1, "x", 0), (5, "y", 1)]
    assert datasets.left_out([a, b]) == [{"extra"}, set()]
    with pytest.raises(ValueError):
        datasets.union_common([a.select("extra"), b])
    frames = spark.createDataFrame([(1,), (2,)], "task_index bigint")
    tasks = spark.createDataFrame([(1, "Hello, world!")], "task_index bigint, task string")
    assert datasets.joined_task(frames.filter("task_index = 1"), tasks, strict=True).first()["task"] == "Hello, world!"
    with pytest.raises(Exception, match="task_index=2 not found in task mapping"):
        datasets.joined_task(frames, tasks, strict=True).collect()
    more = datasets.appended(tasks, spark.createDataFrame([(None, "b"), (None, "a")], "task_index bigint, task string"), "task_index", ["task"])
    assert sorted(map(tuple, more.collect())) == [(1, "Hello, world!"), (2, "a"), (3, "b")]
    assert sorted(map(tuple, datasets.appended(tasks.filter("false"), tasks, "task_index", ["task"]).collect())) == [(0, "Hello, world!")]


def test_key_ranges(spark):
    lines = spark.createDataFrame([(0, "# note"), (1, "3-1: low; x:y"), (2, "2,7 :two"), (3, ""), (4, "junk"), (5, "7-7:last")], "line bigint, value string")
    got = {r["number"]: r["info"] for r in segments.range_info(segments.key_ranges(lines)).collect()}
    assert got == {1: "low; x:y", 2: "two", 3: "low; x:y", 7: "last"}


def test_sessions_and_triples(spark):
    df = spark.createDataFrame([("v", s) for s in (0, 1, 1, 2, 5, 6, 9)], "k string, s int")
    got = segments.sessions(df, ["k"], "s")
    assert sorted((r["start"], r["end"], r["n"]) for r in got.collect()) == [(0, 3, 3), (5, 7, 2), (9, 10, 1)]
    assert sorted((r["start"], r["end"]) for r in segments.split_long(got, 2).collect()) == [(0, 1), (1, 3), (5, 7), (9, 10)]
    videos = spark.createDataFrame([("v", 91), ("w", 30), ("x", 31)], "k string, n bigint")
    assert sorted((r["k"], r["frame_indices"]) for r in segments.second_triples(videos, ["k"], "n").collect()) == [("v", [0, 15, 30]), ("v", [30, 45, 60]), ("v", [60, 75, 90]), ("x", [0, 15, 30])]


def test_nearest(spark):
    r = random.Random(5)
    q = [(k, r.randrange(100), i) for i, k in enumerate("aabbbbaaaz")]
    d = [(k, r.randrange(100), 100 + i) for i, k in enumerate("ab" * 15)]
    got = {x["qid"]: (x["id"], x["late"]) for x in retrieval.nearest(spark.createDataFrame(q, "k string, at long, qid long"), spark.createDataFrame(d, "k string, t long, id long"), ["k"], "at", "t", "id", 3).collect()}
    want = {}
    for k, at, qid in q:
        mine = sorted((abs(t - at), t, i) for kk, t, i in d if kk == k)
        if mine:
            want[qid] = (mine[0][2], mine[0][0] > 3)
    assert got == want


def test_fuzzy(spark):
    df = spark.createDataFrame([("wide wrp",), ("zzz",), (None,)], "t string")
    assert {r[0]: r[1] for r in retrieval.closest_name(df, "t", ["wide wrap", "hook hold"]).collect()} == {"wide wrp": "wide wrap", "zzz": None, None: None}


def test_sampling(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(90)], "i bigint, s string")
    order = sampling.shuffled(df, ["i"], 3).orderBy("place").collect()
    assert [r["place"] for r in order] == list(range(90)) and [r["i"] for r in order] != list(range(90))
    assert [r["i"] for r in sampling.shuffled(df.repartition(7), ["i"], 3).orderBy("place").collect()] == [r["i"] for r in order]
    mix = sampling.mixed(df, "s", ["i"], {"a": 0.5, "b": 0.5}, 200, 1).collect()
    assert sum(r["s"] == "b" for r in mix) == 100 and len({(r["i"], r["copy"]) for r in mix}) == 200
    with pytest.raises(ValueError):
        sampling.mixed(df, "s", ["i"], {"a": 0.5}, 10, 1)
    parts = [{r["i"] for r in sampling.shard(df, ["i"], 4, n).collect()} for n in range(4)]
    assert set.union(*parts) == set(range(90)) and sum(map(len, parts)) == 90
    for rows, size, most, count in ((16, 4, 2, 2), (10, 4, None, 2), (4, 4, 10, 10)):
        got = sampling.batches(df.filter(f"i < {rows}"), ["i"], size, most).groupBy("batch").count().collect()
        assert len(got) == count and all(r["count"] == size for r in got)
    assert sorted(r[0] for r in sampling.retained(spark.createDataFrame([(s,) for s in (1, 5, 10, 12)], "s int"), "s", 5).collect()) == [5, 10, 12]


def test_broker(spark):
    df = spark.createDataFrame([("a", i, [float(i), float(i) + 0.1, float(i) + 0.2]) for i in range(7)], "k string, t bigint, c array<double>")
    assert [r["emitted"] for r in brokers.replayed(df, ["k"], "t", "c", 3).orderBy("t").collect()] == [0.0, 0.1, 0.2, 3.0, 3.1, 3.2, 6.0]


def test_attended(spark):
    r = random.Random(2)
    rows = [("s", i, int(r.random() < 0.4), r.random() < 0.8) for i in range(40)]
    got = {x["p"]: x["attended"] for x in retrieval.attended(spark.createDataFrame(rows, "k string, p int, c int, v boolean"), "k", "p", "c", "v").collect()}
    sums = [sum(x[2] for x in rows[: i + 1]) for i in range(40)]
    assert got == {i: sum(rows[j][3] and sums[j] <= sums[i] for j in range(40)) if rows[i][3] else 0 for i in range(40)}
    assert spark.range(1).select(retrieval.block_pairs(F.lit(7).cast("bigint"), 2, 3)).first()[0] == sum(q // 3 >= k // 2 for q in range(7) for k in range(7))


def test_listed_segments(spark):
    df = spark.createDataFrame([("a", [4, 9]), ("b", [1, 2, 3, 7]), ("c", []), ("d", None), ("e", [5])], "k string, s array<int>")
    assert sorted(map(tuple, segments.listed(df, ["k"], "s").collect())) == [("a", 4, 9), ("b", 1, 4), ("b", 7, 8), ("e", 5, 6)]
    assert sorted(map(tuple, segments.listed(df, ["k"], "s", pairs=False).collect()))[:2] == [("a", 4, 5), ("a", 9, 10)]
