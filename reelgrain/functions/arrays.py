"""Array expressions of the per-record transform algebra; all run inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-6


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def zscore(v: Column, mean: Column, std: Column) -> Column:
    """(x - mean) / (std + 1e-6), with statistics cut to the vector's length."""
    return F.transform(v, lambda x, i: (x - F.get(mean, i)) / (F.get(std, i) + EPSILON))


def unzscore(v: Column, mean: Column, std: Column) -> Column:
    """The inverse; dimensions beyond the statistics pass with mean 0 and deviation 1."""
    return F.transform(v, lambda x, i: x * (F.coalesce(F.get(std, i), F.lit(1.0)) + EPSILON) + F.coalesce(F.get(mean, i), F.lit(0.0)))


def quantile_scale(v: Column, low: Column, high: Column) -> Column:
    """To [-1, 1] between two quantiles."""
    return F.transform(v, lambda x, i: (x - F.get(low, i)) / (F.get(high, i) - F.get(low, i) + EPSILON) * 2 - 1)


def quantile_unscale(v: Column, low: Column, high: Column) -> Column:
    """The inverse; dimensions beyond the statistics pass unchanged."""
    return F.transform(v, lambda x, i: F.when(i < F.size(low), (x + 1) / 2 * (F.get(high, i) - F.get(low, i) + EPSILON) + F.get(low, i)).otherwise(x))


def bool_mask(*counts: int) -> list[bool]:
    """A mask of runs: a positive count of true, a negative one of false; 0 adds nothing."""
    return [n > 0 for n in counts for _ in range(abs(n))]


def _shifted(steps: Column, state: Column, mask: Sequence[bool], sign: int) -> Column:
    flags = F.array(*map(F.lit, mask)) if mask else F.array().cast("array<boolean>")
    return F.transform(steps, lambda step: F.transform(step, lambda x, i: F.when(F.coalesce(F.get(flags, i), F.lit(False)), x + sign * F.get(state, i)).otherwise(x)))


def delta_actions(steps: Column, state: Column, mask: Sequence[bool] | None) -> Column:
    """Actions relative to the state where the mask says so; without a mask the actions themselves."""
    return steps if mask is None else _shifted(steps, state, mask, -1)


def absolute_actions(steps: Column, state: Column, mask: Sequence[bool] | None) -> Column:
    return steps if mask is None else _shifted(steps, state, mask, 1)


def pad_to(v: Column, n: int, value: Column | float = 0.0) -> Column:
    """Filled up to ``n``; longer vectors stay."""
    return F.concat(v, F.array_repeat(F.lit(value) if not isinstance(value, Column) else value, F.greatest(F.lit(0), F.lit(n) - F.size(v))))


def fit_length(v: Column, n: int, value: Column) -> tuple[Column, Column]:
    """Cut or filled to exactly ``n``, and a mask of what is real."""
    kept = F.least(F.size(v), F.lit(n))
    return pad_to(F.slice(v, 1, n), n, value), F.concat(F.array_repeat(F.lit(True), kept), F.array_repeat(F.lit(False), F.lit(n) - kept))


def every(v: Column, stride: int) -> Column:
    return F.filter(v, lambda _, i: i % stride == 0)


def digitize(v: Column, bins: int = 256) -> Column:
    """Bins of equal width over [-1, 1): -1 below, the last one above."""
    return F.transform(v, lambda x: F.when(x < -1, F.lit(-1)).otherwise(F.least(F.floor((x + 1) * (bins // 2)), F.lit(bins - 1)).cast("int")))


def undigitize(tokens: Column, bins: int) -> Column:
    """Token numbers to [-1, 1]."""
    return F.transform(tokens, lambda t: t / F.lit(float(bins)) * 2 - 1)


def reshape(v: Column, rows: int, width: int) -> Column:
    """``rows`` steps of ``width``; a vector that is too short gives zeros."""
    steps = F.transform(F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(v, i * width + 1, F.lit(width)))
    zeros = F.array_repeat(F.array_repeat(F.lit(0.0), width), rows)
    return F.when(F.size(v) >= rows * width, steps).otherwise(zeros)


def roll_right(v: Column, real: Column) -> Column:
    """The first ``real`` entries moved to the end."""
    n = F.size(v)
    return F.concat(F.slice(v, real + 1, n - real), F.slice(v, F.lit(1), real))


def radix_encode(digits: Column, bases: Sequence[int]) -> Column:
    """Digits as one number, the first one lowest."""
    place, places = 1, []
    for b in bases:
        places.append(place)
        place *= b
    return F.aggregate(F.zip_with(digits.cast("array<bigint>"), F.array(*(F.lit(p).cast("bigint") for p in places)), lambda d, p: d * p), F.lit(0).cast("bigint"), lambda a, x: a + x)


def radix_decode(number: Column, bases: Sequence[int]) -> Column:
    place, out = 1, []
    for b in bases:
        out.append((F.floor(number / F.lit(place)) if place > 1 else number) % b)
        place *= b
    return F.array(*(d.cast("bigint") for d in out))


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def linspace(start: Column, stop: Column, n: int) -> Column:
    """``n`` evenly spaced whole numbers from start to stop, cut toward zero."""
    if n == 1:
        return F.array(start.cast("bigint"))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: (start + i * (stop - start) / F.lit(float(n - 1))).cast("bigint"))


def linspace_rounded(count: Column, n: int) -> Column:
    """``n`` evenly spaced frames of ``count``, rounded half to even; one frame is repeated."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(count <= 1, F.lit(0)).otherwise(F.bround(i * (count - 1) / F.lit(float(n - 1)))).cast("bigint"))
