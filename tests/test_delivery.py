import pytest
from pyspark.sql import functions as F

from reelgrain.operators.delivery import RunStore, clip_key, deduplicated_lines, surplus_deliveries
from reelgrain.session import scratch_path

SCHEMA = "line_id bigint, batch_id bigint, base_name string, start_second int, clip string, _bucket int"


def lines(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_clip_key(spark):
    names = ["a/b/Clip_1.MP4", " clip_1 ", "./clip_1.avi", "clip_1", "CLIP_1.mp4 ", "x\\clip_1", "clip.1.mp4", "", "\tclip_1 ", ".mp4", None]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(clip_key(F.col("n"))).collect()]
    assert got == ["clip_1"] * 6 + ["clip.1", "", "clip_1", ".mp4", None]


def test_surplus_with_hard_rows(spark):
    rows = [
        (1, 0, "a.mp4", 5), (2, 1, "A", 5), (3, None, "x/a", 5), (3, None, "x/a", 5), (4, 0, "a", 6), (5, 0, None, 5), (6, 0, None, 5), (7, 0, "a", None),
        (8, 0, "a", None), (None, 0, "a", 5), (9, 3, "", 5), (10, 2, " ", 5), (11, 2, "b" * 100_000, 1), (12, 2, "B" * 100_000, 1),
    ]
    df = lines(spark, rows)
    assert sorted(r[0] for r in surplus_deliveries(df).collect()) == [2, 3, 10, 12]
    kept = deduplicated_lines(df)
    assert kept.columns == df.columns
    ids = sorted((r.line_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 4, 5, 6, 7, 8, 9, 11, None]


def test_no_lines(spark):
    assert surplus_deliveries(lines(spark, [])).count() == 0
    assert deduplicated_lines(lines(spark, [])).count() == 0


def test_hot_message(spark):
    df = spark.range(30_000).select(F.col("id").alias("line_id"), (F.col("id") % 97).alias("batch_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id").cast("string"))).alias("base_name"), F.lit(1).alias("start_second"))
    found = surplus_deliveries(df)
    assert found.count() == 9_999 and found.agg(F.min("line_id")).first()[0] == 3


KINDS = {"k": "string", "n": "bigint"}


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, n bigint")


def held(store):
    return sorted(map(tuple, store.compact().collect()))


def test_upsert_twice_changes_nothing(spark):
    path = scratch_path(spark, "store")
    store = RunStore(spark, path, ["k"], "n", KINDS, 4)
    rows = pairs(spark, ("a", 3), ("a", 1), ("b", 2), (None, 0))
    store.upsert(rows, "1")
    store.upsert(rows, "1")
    store.upsert(pairs(spark, ("a", 2), ("c", 9)), "2")
    assert held(store) == [("a", 1), ("b", 2), ("c", 9)]
    assert held(RunStore(spark, path, ["k"], "n", KINDS, 4)) == held(store)


def test_later_batches_keep_earlier_ones(spark):
    store = RunStore(spark, scratch_path(spark, "store"), ["k"], "n", KINDS, 4)
    store.upsert(pairs(spark, ("a", 1), ("b", 2)), "batch-1")
    store.upsert(pairs(spark, ("a", 8), ("b", 7), ("c", 9)), "batch-5")
    assert held(store) == [("a", 1), ("b", 2), ("c", 9)]


def test_a_run_sent_again_with_fewer_rows_replaces_all_of_it(spark):
    store = RunStore(spark, scratch_path(spark, "store"), ["k"], "n", KINDS, 4)
    store.upsert(spark.range(100).selectExpr("cast(id as string) as k", "id as n"), "x")
    store.upsert(pairs(spark, ("7", 7)), "x")
    assert held(store) == [("7", 7)]
    store.upsert(pairs(spark), "x")
    assert held(store) == []


def test_a_run_needs_a_name(spark):
    store = RunStore(spark, scratch_path(spark, "store"), ["k"], "n", KINDS, 4)
    with pytest.raises(ValueError, match="name"):
        store.upsert(pairs(spark, ("a", 1)), None)


def test_compaction_reads_buckets_without_a_shuffle(spark):
    store = RunStore(spark, scratch_path(spark, "store"), ["k"], "n", KINDS, 4)
    store.upsert(pairs(spark, ("a", 1), ("b", 2)), "1")
    store.upsert(pairs(spark, ("a", 0)), "2")
    plan = store.compact()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
