import pytest
from pyspark.sql import functions as F

from reelgrain.functions import parsing as P
from reelgrain.operators import trees as T


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_parsing(spark):
    v = lambda c: value(spark, c)
    assert v(P.pair(F.lit("Thumb = Abd; VF2: 2-5"), ["vf2"])) == "2-5" and v(P.pair(F.lit("x"), ["y"])) is None
    assert v(P.json_or_pair(F.lit('a {"k": "v"} b'), "k")) == "v" and v(P.json_or_pair(F.lit("- **grasp type**: Power\n"), "grasp_type")) == "Power"
    assert v(P.json_or_pair(F.lit(None).cast("string"), "k")) == "Unknown"
    assert v(P.plain_label(F.lit("maybe Hook\n**Final grasp**: `Power—Wide   Wrap`"))) == "Power-Wide Wrap"
    assert v(P.labelled(F.lit("I say Precision: Nail Pick!"), ["Power", "Precision"])) == "Precision: Nail Pick" and v(P.labelled(F.lit("power grip"), ["Power"])) == "power" and v(P.labelled(F.lit("x"), ["Power"])) is None
    assert v(P.answer(F.lit("```json\n{broken")))["annotations"] is None and v(P.well_formed(P.answer(F.lit("{broken")), F.lit(5))) is False
    assert v(P.well_formed(P.answer(F.lit('{"annotations": []}')), F.lit(1))) is False
    assert [v(P.channels(F.lit(f))) for f in ("gray12le", "rgba", "rgb24", "yuv420p", "??")] == [1, 4, 3, 3, None]
    assert v(P.by_prefix(F.lit("zz"), [("a", 1)], None)) is None


def test_trees(spark):
    ref = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("lora_c", 3.0)], "k string, v double")
    loaded = spark.createDataFrame([("a", 7), ("z", 8), ("b", None)], "k string, v int")
    assert sorted(map(tuple, T.merged_tree(ref, loaded, "k", "v", "lora.*").collect()), key=str) == [("a", 7.0), ("b", None), ("lora_c", 3.0)]
    assert T.checked_deltas([0, -0.05, 0.1], 20) == [0, -1, 2]
    with pytest.raises(ValueError):
        T.checked_deltas([0.03], 20)
    assert [r["n"] for r in T.by_number(spark.createDataFrame([("c10",), ("c9",), ("x",)], "n string"), "n").collect()] == ["x", "c9", "c10"]
    assert T.newest_number(spark.createDataFrame([("7",), ("x8",), ("10",)], "n string"), "n").first()[0] == 10
    assert value(spark, T.split_axis(F.array(F.lit(3), F.lit(8), F.lit(8)), 4)) == 1 and value(spark, T.split_axis(F.array(F.lit(3)), 4)) == -1
    assert T.whole_batches(spark.range(100), ["id"], 30, 8).count() == 24
    assert T.unsupported(spark.sql("select null a, 1 b, interval 1 day c").schema) == ["a", "c"]
    assert T.camera_sources(["cam1_left", "cam1_right", "cam2_left"], "cam1") == ["cam1_left"] and T.kept_columns(["a_depth", "b"], "depth") == ["b"]


def test_cut_at_failure(spark):
    steps = spark.createDataFrame([("a", i) for i in range(5)] + [("b", i) for i in range(3)], "k string, s int")
    reads = spark.createDataFrame([("a", 0, True), ("a", 1, True), ("a", 2, None), ("a", 3, True), ("b", 0, True), ("b", 1, True), ("b", 2, True)], "k string, s int, ok boolean")
    got = sorted((r["k"], r["s"]) for r in T.until_failure(steps, reads, ["k"], "s", "ok").collect())
    assert got == [("a", 0), ("a", 1), ("b", 0), ("b", 1), ("b", 2)]


def test_rules(spark):
    rules = T.Rules()
    rules.add("double", lambda d: d.withColumn("id", F.col("id") * 2))
    rules.add("plus", lambda d: d.withColumn("id", F.col("id") + 1))
    with pytest.raises(KeyError, match="did you mean 'double'"):
        rules.get("doubel")
    with pytest.raises(ValueError):
        rules.add("plus", lambda d: d)
    assert [r[0] for r in T.composed(rules.get("double"), rules.get("plus"))(spark.range(3)).collect()] == [1, 3, 5]


def test_model_calls(spark):
    def model(text):
        if text == "bad":
            raise RuntimeError("no")
        return text.upper()

    df = spark.createDataFrame([("a",), ("bad",), (None,)], "t string")
    assert {r["t"]: r["answer"] for r in T.asked(df, "t", model).collect()} == {"a": "A", "bad": None, None: None}


def test_times(spark):
    df = spark.createDataFrame([("a", 3, None), ("a", 1, 0.5), ("a", 2, None)], "k string, at int, t double")
    assert [(r["at"], r["frame_index"], r["timestamp"]) for r in T.frame_times(df, ["k"], ["at"], F.lit(10.0), "t").orderBy("at").collect()] == [(1, 0, 0.5), (2, 1, 0.1), (3, 2, 0.2)]


def test_small_predicates(spark):
    from reelgrain.operators.retrieval import contains_any
    from reelgrain.operators.schema import concatenated
    from reelgrain.sources.files import matches

    assert value(spark, contains_any(F.lit("ball"), F.lit("small ball, cube"))) and not value(spark, contains_any(F.lit("ball"), F.lit("cube, ")))
    assert value(spark, matches(F.lit("a/success/b"), ".*success.*")) and not value(spark, matches(F.lit("xa"), "a"))
    assert value(spark, concatenated(F.array(F.lit(1.0)), F.array(F.lit(2.0)))) == [1.0, 2.0]
    assert value(spark, P.block(F.lit("t"), ["a", "b"], [F.lit("1"), F.lit(None).cast("string")])) == "t\n- a: 1\n- b: none"
    chosen = spark.range(60).select(P.one_of([F.lit("x"), F.lit("y")], "id").alias("c")).collect()
    assert {r["c"] for r in chosen} == {"x", "y"} and chosen == spark.range(60).select(P.one_of([F.lit("x"), F.lit("y")], "id").alias("c")).collect()
