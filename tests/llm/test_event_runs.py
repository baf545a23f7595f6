import datetime as dt
import random

import pytest

from reelgrain.llm.event_runs import event_runs

SCHEMA = "base_name string, second int, analysis struct<active_hands:array<string>,description:string>, written_at timestamp, event string, block int"
T0 = dt.datetime(2025, 1, 1)


def table(spark, rows):
    return spark.createDataFrame([(c, s, a, T0 + dt.timedelta(seconds=w), "x", 1) for c, s, a, w in rows], SCHEMA)


def runs(spark, rows, **kw):
    return sorted((r["base_name"], r["first_second"], r["last_second"]) for r in event_runs(table(spark, rows), **kw).filter("seconds > 1").collect())


FILL = [(f"fill{i}", 0, (["left"], f"the left hand lifts the {w} toward the upper rack beside cup"), 0) for i, w in enumerate(["mug", "fork", "cork", "belt", "bolt"] * 60)]


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("The hand lifts the mug.", "the  hand lifts_the mug!", True),
        ("The hand lifts the mug.", "A hand lifts mug...", True),
        ("hand lifts toward the mug", "hand lifts towrad the mug", True),
        ("hand lifts toward the mug", "hand lifts tooward the mug", True),
        ("hand lifts towad the mug", "hand lifts toward the mug", True),
        ("hand lifts towad the mug", "hand lifts tooward the mug", True),
        ("The hand lifts the mug, still.", "The hand carefully lifts the mug as before", True),
        ("The right now hand lifts the mug", "The right hand lifts the mug", True),
        ("hand lifts fork", "hand lifts cork", False),
        ("hand lifts belt", "hand lifts bolt", False),
        ("hand lifts mug number 3", "hand lifts mug number 4", False),
        ("hand lifts the mug", "hand lifts the mug beside rack", False),
        ("hand lifts the mug", "hand lowers the mug", False),
        ("left hand lifts", "right hand lifts", False),
    ],
)
def test_pairs(spark, a, b, same):
    rows = [*FILL, ("v", 3, (["Left", "right"], a), 0), ("v", 4, (["RIGHT", "left"], b), 0)]
    assert (("v", 3, 4) in runs(spark, rows)) == same


def test_hands_gaps_and_nulls(spark):
    e = (["left"], "hand lifts mug")
    rows = [("v", 0, e, 0), ("v", 1, (["left", "right"], "hand lifts mug"), 0), ("v", 2, e, 0), ("v", 3, e, 0), ("v", 5, e, 0), ("v", 6, e, 0), ("v", 7, None, 0), ("v", 8, e, 0), ("v", 9, (["left"], None), 0)]
    rows += [("v", 10, e, 0), ("v", 11, (None, "hand lifts mug"), 0), ("v", 12, ([], "hand lifts mug"), 0), (None, 1, e, 0), ("v", None, e, 0), ("w", 0, (["left"], ""), 0), ("w", 1, (["left"], "!"), 0)]
    assert runs(spark, rows) == [("v", 2, 3), ("v", 5, 6), ("v", 11, 12), ("w", 0, 1)]


def test_repeats_and_late_rows(spark):
    e, f = (["left"], "hand lifts mug"), (["left"], "hand drops mug")
    rows = [("v", 2, e, 0), ("v", 1, e, 0), ("v", 2, e, 0), ("v", 3, f, 0), ("v", 3, e, 9), ("v", 4, e, 5), ("v", 4, f, 1)]
    assert runs(spark, rows) == [("v", 1, 4)]


def test_blocks(spark):
    r = random.Random(4)
    words = ["hand lifts mug", "hand drops mug"]
    rows, told = [], {}
    for clip in "ab":
        for s in range(200):
            told[clip, s] = None if r.random() < 0.1 else (["left"], words[r.random() < 0.3])
            rows.append((clip, s, told[clip, s], 0))
    want = []
    for clip in "ab":
        s = 0
        while s < 200:
            e = s
            while told[clip, s] and e + 1 < 200 and told[clip, e + 1] == told[clip, s]:
                e += 1
            if e > s:
                want.append((clip, s, e))
            s = e + 1
    r.shuffle(rows)
    for block in (7, 16, 1024):
        assert runs(spark, rows, block=block) == sorted(want)


def test_counts(spark):
    e = (["left"], "hand lifts mug " + "very " * 5000)
    got = event_runs(table(spark, [("v", s, e, 0) for s in (4, 5, 6, 9)])).orderBy("first_second").collect()
    assert [tuple(r) for r in got] == [("v", 4, 6, 3, 2), ("v", 9, 9, 1, 0)]
    assert event_runs(table(spark, [])).count() == 0
