"""Rules that hold for any input."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelgrain.functions import arrays as A
from reelgrain.operators import idle

FEW = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
NUMBERS = st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=12)


@FEW
@given(st.lists(NUMBERS, min_size=1, max_size=8), st.lists(st.booleans(), max_size=14))
def test_delta_and_absolute_undo_each_other(spark, steps, mask):
    width = min(map(len, steps))
    steps = [s[:width] for s in steps]
    df = spark.createDataFrame([(steps, steps[0])], "a array<array<double>>, s array<double>")
    mask = mask[:width]
    back = df.select(A.absolute_actions(A.delta_actions(F.col("a"), F.col("s"), mask), F.col("s"), mask)).first()[0]
    assert all(abs(x - y) < 1e-6 for a, b in zip(back, steps) for x, y in zip(a, b))


@FEW
@given(st.lists(st.tuples(st.integers(2, 9), st.integers(0, 8)), min_size=1, max_size=6))
def test_mixed_radix(spark, digits):
    bases = [b for b, _ in digits]
    values = [d % b for b, d in digits]
    code = A.radix_encode(F.array(*map(F.lit, values)), bases)
    assert spark.range(1).select(A.radix_decode(code, bases)).first()[0] == values


@FEW
@given(st.lists(st.floats(-3, 3), min_size=1, max_size=20))
def test_digitize_is_monotone_and_bounded(spark, xs):
    xs = sorted(xs)
    got = spark.createDataFrame([(xs,)], "v array<double>").select(A.digitize(F.col("v"))).first()[0]
    assert got == sorted(got) and all(-1 <= b <= 255 for b in got) and all((b == -1) == (x < -1) for b, x in zip(got, xs))


@FEW
@given(st.lists(st.booleans(), min_size=1, max_size=120))
def test_keep_ranges_are_apart_and_long_enough(spark, flags):
    df = spark.createDataFrame([("a", i, f) for i, f in enumerate(flags)], "k string, t bigint, idle boolean")
    got = sorted((r["start"], r["end"]) for r in idle.keep_ranges(df, ["k"], "t").collect())
    assert all(b - a >= 6 for a, b in got) and all(b <= c for (_, b), (c, _) in zip(got, got[1:]))
    assert all(0 <= a and b <= len(flags) - 10 for a, b in got)
