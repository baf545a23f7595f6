"""Attribute rules of queries, worker files, key ranges, chunks without frames, model calls."""

import json

from pyspark.sql import functions as F

from reelgrain.functions import parsing as P
from reelgrain.functions import scalars as X
from reelgrain.operators import segments, trees
from reelgrain.sources import sinks

QUERY = "Opposition: Pad\nThumb Position: ABD\nVirtual Fingers: VF2: 1 vs 2-5\nObject shape: Cylinder / Tapered cylinder\nContact region: finger tips\n"


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_query_fields(spark):
    names = list(P.QUERY_FIELDS)
    assert one(spark, *(P.query_field(F.lit(QUERY), n) for n in names)) == ("pad", "abd", "2-5", "cylinder / tapered cylinder\ncontact region", "finger tips")
    assert one(spark, *(P.query_field(F.lit("virtual fingers: 2"), n) for n in names)) == ("", "", "2", "", "")
    assert one(spark, P.query_field(F.lit(None).cast("string"), "shape")) == (None,)


def test_wishes(spark):
    wish = [("pad", "Pad"), ("pad", "Palm"), ("unknown", "Palm"), ("", None), ("pad", None), (None, "x")]
    assert one(spark, *(P.agrees(F.lit(a).cast("string"), F.lit(b).cast("string")) for a, b in wish)) == (True, False, True, True, False, True)
    lists = [("cylinder", "Disk, Tapered Cylinder"), ("tapered cylinder/ball", "cylinder"), ("ball", "disk, ring"), ("error", "disk"), ("unknown", None)]
    assert one(spark, *(P.overlaps(F.lit(a), F.lit(b).cast("string")) for a, b in lists)) == (True, True, False, True, True)
    assert one(spark, P.mentions(F.lit("A Power grasp by the PALM"), [F.lit("power"), F.lit("Palm"), F.lit(""), F.lit("tip"), F.lit(None).cast("string")])) == (2,)


def test_label_emphasis(spark):
    labels = ["__Power:Full_Palm__", "_Precision_:_Tip_", "Power:Wide_Wrap", "*a* `b` — c", "_", None]
    assert one(spark, *(P.plain_label(F.lit(v).cast("string")) for v in labels)) == ("Power:Full_Palm", "Precision:Tip", "Power:Wide_Wrap", "a b - c", "", None)


def test_named_key_ranges(spark):
    lines = ["episode_000012-episode_000010: named", "3, episode_000004 : two", "# 5: no", "no colon 7", "8-x: broken", "10: last"]
    df = spark.createDataFrame(list(enumerate(lines)), "line bigint, value string")
    assert {r["number"]: r["info"] for r in segments.range_info(segments.key_ranges(df)).collect()} == {10: "last", 11: "named", 12: "named", 3: "two", 4: "two"}


def test_scalars(spark):
    assert one(spark, X.task_of_file(F.lit("/a/b/KITCHEN_open_the_drawer_demo.hdf5")), X.task_of_file(F.lit("x"))) == ("KITCHEN open the drawer", "x")
    assert one(spark, X.action_token(X.action_token(F.lit(7), 1000), 1000), X.action_token(F.lit(0), 1000)) == (7, 871)
    assert one(spark, X.byte_to_unit(F.lit(255)), X.byte_to_unit(F.lit(0)), X.unit_to_byte(X.byte_to_unit(F.lit(77)))) == (1.0, -1.0, 77)
    rates = [one(spark, X.warmup_inverse_root(F.lit(s), 10, 1.0, 100.0))[0] for s in (0, 9, 10, 310)]
    assert [round(r, 6) for r in rates] == [round(1 / 11, 6), round(10 / 11, 6), 1.0, 0.5]


def test_steps_and_chunks(spark):
    df = spark.createDataFrame([(1, [1, 2, 3]), (2, [1]), (3, None)], "id int, frames array<int>")
    good, bad = segments.with_frames(df, "frames")
    assert [r["id"] for r in good.collect()] == [1] and {(r["id"], r["error"]) for r in bad.collect()} == {(2, "1 of at least 3 frames"), (3, "0 of at least 3 frames")}
    steps = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, on boolean")
    assert sorted(r["id"] for r in segments.moving(steps, "on").collect()) == [1, 3]
    cameras = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in (("w", 0), ("l", 1), ("r", 2))))
    assert [len(c) for c in one(spark, segments.cameras_of(cameras, True), segments.cameras_of(cameras, False))] == [1, 2]


def test_files_of_episodes_and_workers(spark, tmp_path):
    frames = spark.createDataFrame([(e, i) for e in (0, 1, 5) for i in range(3)], "episode_index bigint, frame_index bigint")
    sinks.write_episode_files(frames, str(tmp_path / "d"), chunk_size=4)
    assert sorted(str(p.parent.relative_to(tmp_path)) for p in (tmp_path / "d").rglob("*.parquet")) == ["d/data/chunk=0/episode=0", "d/data/chunk=0/episode=1", "d/data/chunk=1/episode=5"]
    lines = spark.createDataFrame([(0, "grün", None), (1, None, "time-out")], "worker int, answer string, error string")
    sinks.append_worker_lines(lines, str(tmp_path / "w"), "worker")
    sinks.append_worker_lines(lines.filter("worker = 1"), str(tmp_path / "w"), "worker")
    found = {p.name: sorted((json.loads(x) for f in p.glob("*.json") for x in f.read_text("utf-8").splitlines()), key=str) for p in (tmp_path / "w").iterdir() if p.is_dir()}
    assert found == {"worker=0": [{"answer": "grün"}], "worker=1": [{"error": "time-out"}] * 2}


def test_model_calls_tell_why(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    got = {r["t"]: (r["answer"], r["answer_error"]) for r in trees.asked(df, "t", trees.mock_model({"a": "yes"}), wait=0.01).collect()}
    assert got == {"a": ("yes", None), "b": (None, "LookupError: no answer to 'b'"), None: (None, None)}
