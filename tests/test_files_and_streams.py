import json

import pytest
from pyspark.sql import functions as F

from reelgrain.operators import stats
from reelgrain.sources import files, generated, hdf5, sinks
from reelgrain.streaming import stateful, windows


def test_json_lines(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"task_index": 1, "task": "größer"}\n\n{broken\n{"task_index": 2}\n', encoding="utf-8")
    assert sorted(map(tuple, files.json_lines(spark, str(p), files.TASKS).collect())) == [(1, "größer"), (2, None)]
    assert [r[0] for r in files.json_lines(spark, str(p), files.TASKS, bad=True).collect()] == ["{broken"]


def test_ranges(spark, tmp_path):
    (tmp_path / "k.json").write_text(json.dumps({"a--b": [[0, 5], [7, 9]], "c--d": []}))
    assert sorted(map(tuple, files.range_map(spark, str(tmp_path / "k.json")).collect())) == [("a--b", 0, 5), ("a--b", 7, 9)]
    (tmp_path / "r.txt").write_text("0-1:x\n# no\n2:y")
    assert [r["line"] for r in files.range_lines(spark, str(tmp_path / "r.txt")).orderBy("line").collect()] == [0, 1, 2]


def test_listing(spark, tmp_path):
    (tmp_path / "a.mp4").write_bytes(b"x" * 2000)
    (tmp_path / "b.mp4").write_bytes(b"x")
    rows = files.listed(spark, str(tmp_path), "*.mp4")
    assert sorted(map(tuple, rows.select("name", "length").collect())) == [("a", 2000), ("b", 1)]
    assert [r["name"] for r in files.not_done(rows, rows).collect()] == ["b"]


def test_dataset_folder(spark, tmp_path):
    frames = spark.createDataFrame([(e, i, float(i)) for e in range(5) for i in range(e + 1)], "episode_index bigint, frame_index bigint, x double")
    root = str(tmp_path / "d")
    sinks.write_episodes(frames, root, chunk_size=2)
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        sinks.write_episodes(frames, root, chunk_size=2)
    assert sorted(p.name for p in (tmp_path / "d" / "data").iterdir() if p.is_dir()) == ["chunk=0", "chunk=1", "chunk=2"]
    part = files.episodes_of(spark, root, [3, 4], 2)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert part.count() == 9 and "PartitionFilters: [" in plan and "chunk#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    told = spark.createDataFrame([(e, e + 1 + (e == 2)) for e in range(5)], "episode_index bigint, length bigint")
    assert [tuple(r) for r in sinks.written_as_told(spark, root, told).collect()] == [(2, 4, 3)]


def test_stats_json(spark):
    df = spark.createDataFrame([([float(3 * i + d) for d in range(3)],) for i in range(4)], "v array<double>")
    s = stats.vector_stats(df, "v")
    back = sinks.read_stats(sinks.stats_json(s, "state"), "state")
    assert [tuple(r) for r in back.orderBy("dim").collect()] == [tuple(r) for r in s.select("dim", "mean", "std", "q01", "q99").orderBy("dim").collect()]
    assert [round(r["std"], 6) for r in s.collect()] == [3.354102] * 3


def test_trajectories(spark):
    df = spark.sql("select 'e' id, array(1, 2) a, array('x', 'y') b")
    assert [tuple(r) for r in files.steps(df, ["a", "b"], ["id"]).collect()] == [("e", 0, 1, "x"), ("e", 1, 2, "y")]
    with pytest.raises(Exception, match="differ in length"):
        files.equal_lengths(spark.sql("select array(1) a, array(1, 2) b"), ["a", "b"]).collect()


def test_small_sinks(spark):
    names = spark.createDataFrame([("out_3",), ("out_11",), ("x",)], "name string")
    assert sinks.next_number(names).first()[0] == 12 and sinks.next_number(names.filter("false")).first()[0] == 0
    media = sinks.renumbered_media(spark.createDataFrame([(4, "v/episode_000004.mp4")], "e int, path string"), spark.createDataFrame([(4, 17)], "e int, new_index int"), ["e"])
    assert media.first()["target"] == "v/episode_000017.mp4"


def test_generated(spark):
    a, b = (generated.observations(spark, "dexterous", 20, 3).orderBy("index").collect() for _ in range(2))
    assert a == b and len(a[0]["state"]) == 31 and all(-1 <= x < 1 for r in a for x in r["state"])


def test_hdf5_is_gated(spark):
    try:
        import h5py  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError):
            hdf5.hdf5_steps(spark, "/nowhere", ["/action"])


ROOT = "/root/testdata/sf0.001"


def run(spark, df, tmp_path, mode, name):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


@pytest.fixture
def stream(spark, tmp_path):
    stored = spark.read.parquet(f"{ROOT}/events.parquet")
    stored.repartition(6).write.parquet(str(tmp_path / "in"))
    return stored, spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))


@pytest.mark.parametrize("name", ["tumbling", "sliding", "session"])
def test_windows_of_streams(spark, stream, tmp_path, name):
    rule = {
        "tumbling": lambda d: windows.tumbling(d, "ts", "1 hour", ["event_type"], "value"),
        "sliding": lambda d: windows.sliding(d, "ts", "1 hour", "30 minutes", ["event_type"], "value"),
        "session": lambda d: windows.session(d, "ts", "2 hours", ["user_id"], "value"),
    }[name]
    stored, live = stream
    got = run(spark, rule(windows.timed(live, "ts", "30 days")), tmp_path, "complete", f"w_{name}").drop("total")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rule(windows.timed(stored, "ts")).drop("total").collect()))


def test_stateful_broker(spark, stream, tmp_path):
    stored, live = stream
    rows = live.select("user_id", "event_id", F.array("value", F.col("value") + 1, F.col("value") + 2).alias("chunk"))
    got = run(spark, stateful.broker(rows, "user_id", "event_id", "chunk", 3), tmp_path, "append", "broker")
    assert got.count() == stored.count() and got.filter("emitted is null").count() == 0


def test_stateful_episodes(spark, stream, tmp_path):
    stored, live = stream
    rows = live.withColumn("last", F.col("event_type") == "error")
    got = run(spark, stateful.episodes(rows, "user_id", "event_id", "value", "last"), tmp_path, "append", "episodes")
    assert got.count() == stored.filter("event_type = 'error'").count()
    assert got.filter("size(values) <> length").count() == 0


def test_stateful_previous(spark, stream, tmp_path):
    stored, live = stream
    got = run(spark, stateful.with_previous(live, "user_id", "event_id", "value"), tmp_path, "append", "previous")
    assert got.count() == stored.count() and got.filter("previous is null").count() == stored.select("user_id").distinct().count()


def test_once(spark, stream, tmp_path):
    _, live = stream
    twice = live.union(live)
    got = run(spark, windows.once(windows.timed(twice, "ts", "30 days"), ["event_id"]), tmp_path, "append", "once")
    assert got.count() == got.select("event_id").distinct().count() > 0


def test_requests_to_files_and_subscribers(spark, tmp_path):
    from reelgrain.streaming import io

    folder = tmp_path / "req"
    folder.mkdir()
    for i in range(5):
        (folder / f"{i}.json").write_text(json.dumps({"robot": "a", "step": i}) + "\n")
    live = io.requests(spark, str(folder), "robot string, step int", per_trigger=2)
    for _ in range(2):  # a restart writes nothing twice
        io.recorded(live, str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    assert sorted(r["step"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 1, 2, 3, 4]
    seen, batches = [], []
    io.subscribed(live, [lambda d, n: seen.extend(r["step"] for r in d.collect()), lambda d, n: batches.append(n)], str(tmp_path / "c2")).awaitTermination()
    assert sorted(seen) == [0, 1, 2, 3, 4] and batches == [0, 1, 2]
