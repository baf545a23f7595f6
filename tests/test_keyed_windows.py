"""Windows per key over range partitions, against plain loops, with a key that holds most rows."""

import random

from pyspark.sql import functions as F

from reelgrain.operators import chunks as C
from reelgrain.operators import metrics, retrieval, segments

SCHEMA = "k string, t bigint, v bigint, _p int, _before int"


def rows(seed=4, n=400):
    r = random.Random(seed)
    times = r.sample(range(10 * n), n)
    return [(r.choice(["hot", "hot", "hot", "a", None]), t, r.choice([None, 1, 2, 5]), 0, 0) for t in times]


def ordered(data):
    by = {}
    for row in sorted(data, key=lambda x: x[1]):
        by.setdefault(row[0], []).append(row)
    return by


def test_totals_and_last_values(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).select("k", "t", "v")
    for partitions in (1, 7, 40):
        r = C.ranged(df, ["k"], ["t"], partitions=partitions)
        out = C.total_in(r, ["k"], ["t"], "v", "sum")
        out = C.last_in(out, ["k"], ["t"], F.col("v"), "up")
        out = C.last_in(out, ["k"], ["t"], F.struct(F.col("v").alias("x")), "was", before=True)
        out = C.last_in(out, ["k"], ["t"], F.col("v"), "down", backward=True)
        got = {x["t"]: (x["sum"], x["up"], x["was"] and x["was"]["x"], x["down"]) for x in out.collect()}
        for own in ordered(data).values():
            for i, (_, t, *_rest) in enumerate(own):
                vs = [x[2] for x in own]
                known = [v for v in vs[: i + 1] if v is not None]
                after = [v for v in vs[i:] if v is not None]
                assert got[t] == (sum(v or 0 for v in vs[:i]), known[-1] if known else None, vs[i - 1] if i else None, after[0] if after else None)
    assert r.select("_p").distinct().count() > 10


def test_numbers_start_anew_for_each_key(spark):
    data = rows(5)
    got = {x["t"]: x["i"] for x in C.numbered_by(spark.createDataFrame(data, SCHEMA).select("k", "t"), ["k"], ["t"], "i").collect()}
    assert got == {row[1]: i for own in ordered(data).values() for i, row in enumerate(own)}
    assert C.numbered_by(spark.createDataFrame([], SCHEMA).select("k", "t"), ["k"], ["t"], "i").count() == 0


def test_users_of_them(spark):
    data = rows(6)
    df = spark.createDataFrame(data, SCHEMA).select("k", "t", "v")
    rate = {x["t"]: x["rate"] for x in metrics.running_rate(df, ["k"], ["t"], F.col("v") > 1).collect()}
    before = {x["t"]: x["p"] for x in metrics.previous(df, ["k"], ["t"], "v", "p").collect()}
    for own in ordered(data).values():
        for i, row in enumerate(own):
            known = [x[2] > 1 for x in own[: i + 1] if x[2] is not None]
            assert rate[row[1]] == (sum(known) / len(known) if known else None)
            assert before[row[1]] == (own[i - 1][2] if i else None)
    hertz = {x["k"]: x["hertz"] for x in metrics.arrival_rate(df, ["k"], F.col("t")).collect()}
    assert all(abs(hertz[k] - (len(own) - 1) / (own[-1][1] - own[0][1])) < 1e-12 for k, own in ordered(data).items())
    cut = segments.sessions(df.filter("k is not null"), ["k"], "t", 20).collect()
    assert sum(x["n"] for x in cut) == sum(r[0] is not None for r in data)
    for k, own in ordered(data).items():
        if k is not None:
            assert sum(x["k"] == k for x in cut) == 1 + sum(b[1] - a[1] > 20 for a, b in zip(own, own[1:]))


def test_tiers_without_pairs_of_all(spark):
    features = [("a", "ea"), ("b", "eb"), ("c", "ec")]
    r = random.Random(2)
    entries = [(f"e{i:02d}", i, r.choice("xyz"), r.choice("pq"), r.choice(["m", None])) for i in range(12)]
    queries = [(f"q{i}", r.choice("xyzw"), r.choice(["p", "q", "r", None]), r.choice(["m", "n"])) for i in range(30)]
    out = retrieval.tiered_top(spark.createDataFrame(queries, "query string, a string, b string, c string"), spark.createDataFrame(entries, "name string, pos int, ea string, eb string, ec string"), features, [[0, 1, 2], [0, 1], [0]], "query", "name", "pos", 4)
    got = {}
    for x in out.collect():
        got.setdefault(x["query"], []).append((x["rank"], x["name"], x["tier"], x["score"]))
    for q, *own in queries:
        same = {e[0]: [o is not None and o == v for o, v in zip(own, e[2:])] for e in entries}
        tier = {n: 0 if all(s) else 1 if s[0] and s[1] else 2 if s[0] else 3 for n, s in same.items()}
        best = min(tier.values())
        want = sorted((-sum(same[e[0]]), e[1], e[0]) for e in entries if tier[e[0]] == best)[:4]
        assert sorted(got[q]) == [(i + 1, name, best, -s) for i, (s, _, name) in enumerate(want)]
