"""Exact cases of the transform algebra, and invariants."""

import math

import pytest
from pyspark.sql import functions as F

from reelgrain.functions import arrays as A
from reelgrain.functions import scalars as X
from reelgrain.operators import schema as S


def one(spark, *columns, row=None):
    df = spark.range(1) if row is None else spark.createDataFrame([row[0]], row[1])
    return df.select(*columns).first()


def test_repack(spark):
    df = spark.sql("select named_struct('c', 1) b, named_struct('f', 2) e")
    assert S.repacked(df, {"a": {"b": "b/c"}, "d": "e/f"}).first().asDict(True) == {"a": {"b": 1}, "d": 2}
    with pytest.raises(KeyError):
        S.repacked(df, {"x": "b/z"})


def test_delta_and_absolute(spark):
    df = spark.sql("select array(1d, 2d, 3d) s, array(array(3d, 4d, 5d), array(5d, 6d, 7d)) a")
    assert df.select(A.delta_actions(F.col("a"), F.col("s"), [False, True])).first()[0] == [[3, 2, 5], [5, 4, 7]]
    assert df.select(A.absolute_actions(F.col("a"), F.col("s"), [False, True])).first()[0] == [[3, 6, 5], [5, 8, 7]]
    assert df.select(A.delta_actions(F.col("a"), F.col("s"), None)).first()[0] == [[3, 4, 5], [5, 6, 7]]
    assert df.select(A.delta_actions(F.lit(None).cast("array<array<double>>"), F.col("s"), [True])).first()[0] is None


def test_bool_mask():
    assert A.bool_mask(2, -2, 2) == [True, True, False, False, True, True]
    assert A.bool_mask(2, 0, 2) == [True] * 4


def test_rename(spark):
    df = spark.sql("select named_struct('b', 1, 'c', 2) a")
    assert S.renamed_paths(df, {"a/b": "a/c", "a/c": None}).first().asDict(True) == {"a": {"c": 1}}
    with pytest.raises(ValueError, match="Key 'a/c' already exists in output"):
        S.renamed_paths(df, {"a/b": "a/c"})
    assert S.renamed_paths(df, {"a": None}).first().asDict(True) == {"a": {"b": 1, "c": 2}}
    assert S.renamed_paths(df, {"a.+": None}).columns == []
    two = spark.sql("select named_struct('b', 1, 'c', 1) a, named_struct('c', 2) b")
    assert S.renamed_paths(two, {"(.+)/c": r"\1/d"}).first().asDict(True) == {"a": {"b": 1, "d": 1}, "b": {"d": 2}}
    with pytest.raises(ValueError):
        S.renamed_paths(two, {"b/c": "a/b/x"})


def test_flatten_round_trip(spark):
    df = spark.sql("select named_struct('b', named_struct('x', 1), 'c', 2) a, 3 d")
    flat = S.flattened(df)
    assert flat.columns == ["a/b/x", "a/c", "d"]
    assert S.unflattened(flat).first().asDict(True) == df.first().asDict(True)


def test_columns(spark):
    df = spark.sql("select 1 a, 'x' s, cast(null as int) n")
    assert S.without_strings(df).columns == ["a", "n"]
    assert S.with_default(df, "n", 5).first()["n"] == 5 and S.with_default(df, "q", "hi").first()["q"] == "hi"
    assert S.first_of(df, ["z", "n", "a"], "o").first()["o"] == 1
    with pytest.raises(ValueError):
        S.applied(df, {"zz": 1}, lambda c, x: c, strict=True)
    assert S.applied(df, {"a": 2, "zz": 1}, lambda c, x: c * x).first()["a"] == 2
    images = S.camera_columns(spark.sql("select cast('abc' as binary) cam_high"), ["cam_high", "cam_low"], True).first()
    assert images["image_mask"].asDict() == {"cam_high": True, "cam_low": False} and images["image"]["cam_low"] == b""
    assert S.pruned_features({"observation.camera_1.rgb": {}, "observation.camera_2.rgb": {}, "action": {}}, ["camera_2"]).keys() == {"observation.camera_2.rgb", "action"}


def test_checks(spark):
    df = spark.sql("select array(1d, 2d) v")
    assert df.select(S.checked_length(F.col("v"), 2, "v")).first()[0] == [1, 2]
    with pytest.raises(Exception, match="expected 3 values, got 2"):
        df.select(S.checked_length(F.col("v"), 3, "v")).first()
    with pytest.raises(Exception, match="both or neither"):
        df.select(S.both_or_neither(F.lit(None), F.lit(1), "tokens, mask")).first()


def test_padding(spark):
    v = F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))
    assert one(spark, A.pad_to(v, 5))[0] == [1, 2, 3, 0, 0] and one(spark, A.pad_to(v, 2))[0] == [1, 2, 3]
    fixed, mask = A.fit_length(v, 2, F.lit(0.0))
    assert tuple(one(spark, fixed, mask)) == ([1, 2], [True, True])
    assert one(spark, A.roll_right(v, F.lit(1)))[0] == [2, 3, 1]
    assert one(spark, A.reshape(v, 1, 2))[0] == [[1, 2]] and one(spark, A.reshape(v, 2, 2))[0] == [[0, 0], [0, 0]]
    assert one(spark, A.every(v, 2))[0] == [1, 3]


def test_digitize(spark):
    xs = [-2.0, -1.0, -0.999, 0.0, 1 - 1 / 128, 1.0, 5.0]
    assert one(spark, A.digitize(F.array(*map(F.lit, xs))))[0] == [-1, 0, 0, 128, 255, 255, 255]
    assert one(spark, A.undigitize(F.array(F.lit(0), F.lit(128)), 256))[0] == [-1, 0]


def test_scale_round_trip(spark):
    v = F.array(F.lit(0.5), F.lit(-3.0), F.lit(7.0))
    two = F.array(F.lit(1.0), F.lit(2.0))
    back = one(spark, A.unzscore(A.zscore(F.slice(v, 1, 2), two, two), two, two))[0]
    assert back == pytest.approx([0.5, -3.0])
    low, high = F.array(F.lit(-1.0), F.lit(-4.0)), F.array(F.lit(1.0), F.lit(4.0))
    scaled = F.concat(A.quantile_scale(F.slice(v, 1, 2), low, high), F.array(F.lit(7.0)))
    assert one(spark, A.quantile_unscale(scaled, low, high))[0] == pytest.approx([0.5, -3.0, 7.0])


def test_samples(spark):
    assert one(spark, A.linspace(F.lit(0), F.lit(9), 4))[0] == [0, 3, 6, 9]
    assert one(spark, A.linspace(F.lit(3), F.lit(9), 1))[0] == [3]
    assert one(spark, A.linspace_rounded(F.lit(1), 3))[0] == [0, 0, 0]
    assert one(spark, A.linspace_rounded(F.lit(6), 3))[0] == [0, 2, 5]  # 2.5 goes to the even one


def test_text(spark):
    assert one(spark, X.clean_prompt(F.lit(" \tpick_up\nit  ")))[0].strip() == "pick up it"
    assert one(spark, X.clean_label(F.lit(" Wide_WRAP\n")))[0] == "wide wrap"
    assert one(spark, X.prompt(F.lit("go"), F.array(F.lit(1), F.lit(-1)), False))[0] == "Task: go, State: 1 -1;\n"
    assert one(spark, X.between_marks(F.lit("x Action: a b|c"), "Action: ", "|"), X.between_marks(F.lit("x"), "Action: ", "|"))[:] == ("a b", None)
    assert one(spark, X.json_object(F.lit('so {"a": {"b": 1}}\n ok')))[0] == '{"a": {"b": 1}}'
    assert one(spark, X.episode_number(F.lit("episode_000012")), X.episode_number(F.lit("none")))[:] == (12, -1)
    assert one(spark, X.episode_path(F.lit(1234)))[0] == "data/chunk-001/episode_001234.parquet"
    assert one(spark, X.data_url(F.lit(b"ab")))[0] == "data:image/png;base64,YWI="


def test_geometry(spark):
    box = one(spark, X.letterbox(F.lit(640), F.lit(480), 224, 224))[0]
    assert box.asDict() == {"width": 224, "height": 168, "left": 0, "right": 0, "top": 28, "bottom": 28}
    assert one(spark, X.axis_angle(*map(F.lit, (0.0, 0.0, 0.0, 1.0))))[0] == [0, 0, 0]
    assert one(spark, X.axis_angle(*map(F.lit, (0.0, 0.0, math.sin(0.5), math.cos(0.5)))))[0] == pytest.approx([0, 0, 1.0])
    assert one(spark, X.frame_at(F.lit(0.5), F.lit(1), F.lit(10)), X.frame_at(F.lit(1.5), F.lit(1), F.lit(10)), X.frame_at(F.lit(99.0), F.lit(1), F.lit(10)))[:] == (0, 2, 9)
    assert len(one(spark, X.wave_embedding(F.lit(0.3), 8, 0.004, 4.0))[0]) == 8
    assert one(spark, X.linear_to_radian(F.lit(0.05), 0.036, 0.022))[0] == pytest.approx(math.asin(min(1, (0.022**2 + 0.05**2 - 0.036**2) / (2 * 0.022 * 0.05))))
