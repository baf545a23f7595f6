import random
from collections import Counter

import numpy as np
import pytest

from reelgrain.llm import packing
from reelgrain.llm.packing import fill_report, packed, plan_windows, token_counts, window_width

DOCS = "doc_id bigint, source string, text string, group bigint, capacity int"


def best_fit(sizes, capacity):
    """Containers of the best-fit decreasing rule, by search."""
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms)


def containers(counts, capacity, weights=None):
    """Every container of a plan as {queue: tokens}, repeats written out."""
    out = {}
    width = window_width(capacity)
    for first, times, used in plan_windows(counts, capacity, weights):
        for k in range(times):
            for (queue, size), places in used.items():
                for place in places:
                    held = out.setdefault(first + k * width + place, {})
                    held[queue] = held.get(queue, 0) + size
    return [out[c] for c in sorted(out)]


def test_as_few_as_best_fit():
    for seed in range(8):
        r = np.random.default_rng(seed)
        sizes = np.clip(r.lognormal(4.5, 1, 800).astype(int), 1, 256)
        counts = Counter(zip(r.choice(3, 800, p=[0.6, 0.3, 0.1]).tolist(), sizes.tolist()))
        held = [sum(c.values()) for c in containers(counts, 256)]
        assert max(held) <= 256 and sum(held) == sizes.sum() and len(held) <= best_fit(sizes.tolist(), 256) * 1.01 + 1


@pytest.mark.parametrize("weights", [None, {0: 0.2, 1: 0.3, 2: 0.5}])
def test_mixture_is_kept(weights):
    r = np.random.default_rng(3)
    counts = Counter(zip(r.choice(3, 20_000, p=[0.5, 0.3, 0.2]).tolist(), r.integers(5, 60, 20_000).tolist()))
    whole = [sum(s * n for (q, s), n in counts.items() if q == k) for k in range(3)]
    want = weights or {k: whole[k] / sum(whole) for k in range(3)}
    held = containers(counts, 2048, weights)
    lasting = min(whole[k] / want[k] for k in range(3)) / 2048  # until then no source runs out
    width = window_width(2048)
    windows = [held[i : i + width] for i in range(0, int(lasting) - width, width)]
    assert len(windows) > 5
    for w in windows:
        tokens = sum(sum(c.values()) for c in w)
        assert all(abs(sum(c.get(k, 0) for c in w) / tokens - want[k]) < 0.02 for k in range(3))
    assert sum(sum(c.values()) for c in held) == sum(whole)


def test_sources_without_weight_come_last_but_come():
    held = containers({(0, 10): 100, (1, 10): 100}, 100, {0: 1.0})
    assert sum(c.get(1, 0) for c in held) == 1000 and all(c == {0: 100} for c in held[:10])


def test_many_equal_documents_need_few_windows():
    counts = {(q, s): 1_000_000 for q in range(4) for s in range(1, 65)}
    plan = list(plan_windows(counts, 64))
    assert len(plan) < 600
    used = Counter()
    for _, times, cells in plan:
        for cell, places in cells.items():
            used[cell] += times * len(places)
    assert used == counts


def test_table(spark, monkeypatch):
    monkeypatch.setattr(packing, "QUEUES", 2)
    monkeypatch.setattr(packing, "REACH", 7)
    r = random.Random(1)
    rows = [(i, r.choice(["a", "b", None]), " ".join(["word"] * r.choice([0, 1, 5, 20, 70])), 1, 2) for i in range(150)]
    rows += [(1000, "a", "word " * 30_000, 0, 0), (1001, "a", None, 0, 0), (1002, "b", "", 0, 0), (None, "a", "lost", 0, 0), rows[3]]
    df = spark.createDataFrame(rows, DOCS)
    targets = spark.createDataFrame([("small", 32), ("large", 100), ("small", 16), (None, 5), ("bad", 0), ("null", None)], "target_name string, capacity_tokens int")
    tokens = {x["doc_id"]: x["n_tokens"] for x in token_counts(df).collect()}
    assert set(tokens) == {x[0] for x in rows} - {None} and tokens[1001] == 0
    out = packed(df, targets).collect()
    for name, capacity in (("small", 32), ("large", 100)):
        mine = [x for x in out if x["target_name"] == name]
        held, pieces = {}, {}
        for x in mine:
            held[x["container"]] = held.get(x["container"], 0) + x["n_tokens"]
            pieces.setdefault(x["doc_id"], []).append((x["part"], x["start_token"], x["n_tokens"]))
        assert max(held.values()) <= capacity and set(pieces) == set(tokens)
        for d, p in pieces.items():
            p.sort()
            assert sum(n for *_, n in p) == tokens[d] and [a for a, *_ in p] == list(range(len(p)))
            assert len(p) == max(1, -(-tokens[d] // capacity)) and all(start == i * capacity for i, start, _ in p)
        assert len(held) <= -(-sum(tokens.values()) // capacity) + 8
    assert {x["target_name"] for x in out} == {"small", "large"}
    report = {x["target_name"]: x for x in fill_report(packed(df, targets)).collect()}
    assert report["small"]["documents"] == len(tokens) and report["small"]["fewest"] <= report["small"]["containers"]
    assert all(0 <= x["mix_distance"] <= 1 for x in report.values())
    assert sorted(map(tuple, packed(df.repartition(7), targets).collect())) == sorted(map(tuple, out))


def test_weights_of_a_table(spark, monkeypatch):
    monkeypatch.setattr(packing, "WINDOW", 512)
    df = spark.createDataFrame([(i, ["a", "b", None][i % 3], "word " * (3 + i % 7), 1, 2) for i in range(3000)], DOCS)
    targets = spark.createDataFrame([("t", 128)], "target_name string, capacity_tokens int")
    out = packed(df, targets, weights={"a": 0.6, None: 0.4}).collect()
    assert sorted(x["doc_id"] for x in out) == list(range(3000))
    early = [x for x in out if x["container"] < 4 * window_width(128)]
    share = sum(x["n_tokens"] for x in early if x["source"] == "a") / sum(x["n_tokens"] for x in early)
    assert abs(share - 0.6) < 0.05 and not any(x["source"] == "b" for x in early)


def test_empty(spark):
    df = spark.createDataFrame([], DOCS)
    targets = spark.createDataFrame([("t", 8)], "target_name string, capacity_tokens int")
    assert packed(df, targets).count() == 0
    assert packed(spark.createDataFrame([(1, "a", "x", 0, 0)], DOCS), targets.filter("false")).count() == 0
