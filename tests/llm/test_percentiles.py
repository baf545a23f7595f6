import datetime as dt

import numpy as np
import pytest

from reelgrain.llm import percentiles as P

FRAMES = "index bigint, episode_index bigint, source string, `observation.state` array<float>, action array<float>, day string, dim int, n int"


def error(sorted_x, value, q):
    n = len(sorted_x)
    rank = min(n, max(1, int(np.ceil(q * n - 1e-9))))
    a, b = np.searchsorted(sorted_x, value, "left") + 1, np.searchsorted(sorted_x, value, "right")
    return 0 if a <= rank <= b else min(abs(a - rank), abs(b - rank)) / (min(q, 1 - q) * n)


def sketch(x, pieces=1):
    parts = []
    for part in np.array_split(x, pieces):
        low, high = P.TailSketch(x.shape[1], 1), P.TailSketch(x.shape[1], 2)
        for batch in np.array_split(part, max(1, len(part) // 5000)):
            low.add(batch)
            low.compress()
            high.add(-batch)
            high.compress()
        parts.append(P.pack((~np.isnan(part)).sum(axis=0), (low, high)))
    return P.merge(parts)


@pytest.mark.parametrize("pieces", [1, 7, 60])
@pytest.mark.parametrize("n", [1, 3, 384, 385, 20_000, 200_000])
def test_rank_error(n, pieces):
    rng = np.random.default_rng(n)
    x = np.stack([rng.normal(size=n), rng.pareto(1.2, n), np.round(rng.normal(size=n)), np.sort(rng.normal(size=n)), -np.arange(n)], axis=1).astype(np.float32)
    counts, found = P.percentiles(sketch(x, min(pieces, n)))
    assert (counts == n).all()
    worst = max(error(np.sort(x[:, d]), np.float32(found[d, k]), q) for d in range(x.shape[1]) for k, q in enumerate(P.PERCENTILES))
    assert worst <= (P.RANK_ERROR if n > 2 * P.SECTION * P.SECTIONS else 0)


def test_missing_readings():
    x = np.arange(3000, dtype=np.float32)[:, None].repeat(2, axis=1)
    x[::3, 1] = np.nan
    n, found = P.percentiles(sketch(x))
    kept = x[~np.isnan(x[:, 1]), 1]
    assert n.tolist() == [3000, 2000]
    assert max(error(kept, np.float32(found[1, k]), q) for k, q in enumerate(P.PERCENTILES)) <= P.RANK_ERROR
    empty = np.full((5, 1), np.nan, np.float32)
    n, found = P.percentiles(sketch(empty))
    assert n.tolist() == [0] and np.isnan(found).all()
    wide = P.merge([sketch(x[:10]), sketch(x[:5, :1])])
    assert P.percentiles(wide)[0].tolist() == [15, 6]


def frames(spark, rows):
    return spark.createDataFrame([(*r, "d", 0, 0) for r in rows], FRAMES)


def test_table(spark):
    rows = [(i, i // 50, "a" if i % 3 else "b", [float(i), float(-i)], [1.0]) for i in range(900)]
    rows += rows[:40]
    rows += [(2000, 1, "a", None, [float("nan")]), (2001, 1, "a", [], None), (2002, 1, "a", [float("inf"), None], [2.0, 3.0]), (2003, None, None, [5.0], [5.0]), (None, 1, "a", [9e9], [1.0])]
    episodes = spark.createDataFrame([(e, dt.datetime(2025, 1, 1 + e % 3) if e % 5 else None) for e in range(18)] * 2, "episode_index bigint, recorded_at timestamp")
    rigs = spark.createDataFrame([("a", "arm"), ("b", "arm"), ("b", "arm")], "source string, robot_type string")
    got = P.all_percentiles(frames(spark, rows), episodes, rigs).collect()
    by = {(r["scope"], r["name"], r["day"], r["field_name"], r["dim"]): r for r in got}
    a = by["source", "a", None, "observation.state", 0]
    xs = np.array([i for i in range(900) if i % 3], np.float32)
    assert a["n"] == 600 and error(xs, np.float32(a["p50"]), 0.5) <= P.RANK_ERROR and error(xs, np.float32(a["p99"]), 0.99) <= P.RANK_ERROR
    assert by["robot_type", "arm", None, "observation.state", 1]["n"] == 900
    assert by["source", "a", None, "action", 1]["n"] == 1 and by["source", "a", None, "action", 1]["p50"] == 3.0
    assert by["source", None, None, "observation.state", 0]["n"] == 1 and by["robot_type", None, None, "observation.state", 0]["p01"] == 5.0
    days = [r for r in got if r["scope"] == "source_day" and r["name"] == "a" and r["field_name"] == "observation.state" and r["dim"] == 0]
    assert len(days) == 4 and sum(r["n"] for r in days) == 600
    for r in days:
        own = [i for i in range(900) if i % 3 and (None if (i // 50) % 5 == 0 else f"2025-01-{1 + i // 50 % 3:02d}") == r["day"]]
        assert r["n"] == len(own) and r["p50"] == own[int(np.ceil(0.5 * len(own))) - 1]


def test_slices(spark, monkeypatch):
    """Days that are cut, days that share a slice, and several partitions: the rows alone tell the answers."""
    rows = [(i, i // 10, "a", [float(i)], None) for i in range(200)] + [(1000 + i, 15, "b", [float(i)], None) for i in range(50)]
    episodes = spark.createDataFrame([(e, dt.datetime(2025, 1, 1) + dt.timedelta(days=min(e, 15))) for e in range(20)], "episode_index bigint, recorded_at timestamp")
    rigs = spark.createDataFrame([("a", "arm"), ("b", "arm")], "source string, robot_type string")
    ask = lambda df: sorted(map(str, P.all_percentiles(df, episodes, rigs).collect()))
    whole = ask(frames(spark, rows))
    monkeypatch.setattr(P, "SLICE", 25)
    monkeypatch.setattr(P, "FAN", 2)
    assert ask(frames(spark, rows)) == ask(frames(spark, rows[::-1]).repartition(9)) == whole
    days = P.daily_sketches(frames(spark, rows), episodes)
    assert days.filter("source = 'a'").count() == 16 and P.answers(days, ["source", "day"]).filter("n = 50").count() == 2


def test_order_and_merges_at_any_size():
    """Sorted readings and many small sketches, of which each level compacts often."""
    x = np.arange(1_500_000, dtype=np.float32)[:, None]
    for order in (x, x[::-1], np.random.default_rng(5).permutation(x)):
        _, found = P.percentiles(sketch(order, 300))
        assert max(error(x[:, 0], np.float32(found[0, k]), q) for k, q in enumerate(P.PERCENTILES)) <= P.RANK_ERROR


def test_empty_and_all_null(spark):
    episodes = spark.createDataFrame([], "episode_index bigint, recorded_at timestamp")
    rigs = spark.createDataFrame([], "source string, robot_type string")
    assert P.all_percentiles(frames(spark, []), episodes, rigs).count() == 0
    got = P.all_percentiles(frames(spark, [(1, 1, "a", [float("nan")], None)]), episodes, rigs).collect()
    assert {(r["n"], r["p50"]) for r in got} == {(0, None)}
