"""Smaller operators of merging and loading: keyed trees, failed reads, times, numeric order, named rules."""

from __future__ import annotations

import difflib
import random
import re
import time
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelgrain.operators.chunks import numbered_by


def merged_tree(reference: DataFrame, loaded: DataFrame, key: str, value: str, missing: str) -> DataFrame:
    """The reference's keys with the loaded value where there is one, else the reference's own if the key matches ``missing``.

    Loaded keys that the reference doesn't have are left out, and so are its keys that are neither loaded nor match.
    """
    rows = reference.join(loaded.select(key, F.col(value).cast(reference.schema[value].dataType).alias("_loaded"), F.lit(True).alias("_there")), key, "left")
    kept = rows.filter(F.col("_there").isNotNull() | F.col(key).rlike(f"^(?:{missing})$"))
    return kept.select(key, F.when(F.col("_there").isNotNull(), F.col("_loaded")).otherwise(F.col(value)).alias(value))


def until_failure(steps: DataFrame, reads: DataFrame, keys: Sequence[str], step: str, ok: str) -> DataFrame:
    """Steps joined with the camera reads at them, up to the first failed or missing read of each key."""
    rows = steps.join(reads, [*keys, step], "left")
    failed = F.min(F.when(~F.coalesce(F.col(ok), F.lit(False)), F.col(step)))
    first = rows.groupBy(*keys).agg(failed.alias("_failed"))
    return rows.join(first, list(keys)).filter(F.col("_failed").isNull() | (F.col(step) < F.col("_failed"))).drop("_failed")


def frame_times(df: DataFrame, keys: Sequence[str], order: Sequence[str], fps: Column, given: str | None = None) -> DataFrame:
    """Frames numbered by arrival, with the time given or ``frame_index / fps``."""
    rows = numbered_by(df, keys, order, "frame_index")
    regular = F.col("frame_index") / fps
    return rows.withColumn("timestamp", F.coalesce(F.col(given), regular) if given else regular)


def interpolated(moves: DataFrame, keys: Sequence[str], start: str, end: str, steps: int) -> DataFrame:
    """Straight lines between two vectors, ends included: ``step`` and ``target``."""
    rows = moves.select(*keys, start, end, F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"))
    return rows.select(*keys, "step", F.zip_with(start, end, lambda a, b: a + (b - a) * F.col("step") / float(max(1, steps - 1))).alias("target"))


def by_number(df: DataFrame, name: str) -> DataFrame:
    """Names with the number in them (-1 without), in that order, equal ones as they sort."""
    number = F.coalesce(F.nullif(F.regexp_extract(name, r"(\d+)", 1), F.lit("")).cast("bigint"), F.lit(-1).cast("bigint"))
    return df.withColumn("number", number).orderBy("number", name)


def newest_number(df: DataFrame, name: str) -> DataFrame:
    """The largest of the names that are numbers."""
    return df.filter(F.col(name).rlike("^[0-9]+$")).agg(F.max(F.col(name).cast("bigint")).alias("newest"))


def split_axis(shape: Column, parts: int) -> Column:
    """The place of the largest dimension that is divisible by ``parts``, the first of equals; -1 without one."""
    fitting = F.filter(F.transform(shape, lambda n, i: F.struct((-n).alias("n"), i.alias("i"))), lambda d: d["n"] % parts == 0)
    return F.coalesce(F.get(F.array_sort(fitting), F.lit(0))["i"], F.lit(-1))


def whole_batches(df: DataFrame, key: Sequence[str], most: int, size: int) -> DataFrame:
    """At most ``most`` rows by hash, as many as fill whole batches: the operator is a sample."""
    return df.orderBy(F.xxhash64(*key), *key).limit(most // size * size)


def checked_deltas(deltas: Sequence[float], fps: float, tolerance: float = 1e-4) -> list[int]:
    """Time distances as frames; one that is no multiple of a frame is an error."""
    frames = [round(d * fps) for d in deltas]
    wrong = [d for d, n in zip(deltas, frames) if abs(d * fps - n) > tolerance * fps]
    if wrong:
        raise ValueError(f"{wrong} are no multiples of 1/{fps} s")
    return frames


def unsupported(schema: T.StructType) -> list[str]:
    """Columns of kinds that recordings can't hold."""
    return [f.name for f in schema.fields if isinstance(f.dataType, (T.NullType, T.CalendarIntervalType, T.DayTimeIntervalType, T.YearMonthIntervalType))]


class Rules:
    """Named rules of DataFrame -> DataFrame; an unknown name is told with the nearest known one."""

    def __init__(self) -> None:
        self.held: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def add(self, name: str, rule: Callable[[DataFrame], DataFrame]) -> None:
        if name in self.held:
            raise ValueError(f"'{name}' is there already")
        self.held[name] = rule

    def get(self, name: str) -> Callable[[DataFrame], DataFrame]:
        if name not in self.held:
            near = difflib.get_close_matches(name, self.held, 1, 0.0)
            raise KeyError(f"'{name}' is not known" + (f"; did you mean '{near[0]}'?" if near else ""))
        return self.held[name]


def composed(*rules: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Rules one after the other; Catalyst sees one plan."""

    def run(df: DataFrame) -> DataFrame:
        for rule in rules:
            df = df.transform(rule)
        return df

    return run


def asked(df: DataFrame, text: str, model: Callable[[str], str], *, attempts: int = 2, wait: float = 1.0, out: str = "answer") -> DataFrame:
    """Each text answered by a model outside of Spark, in Arrow batches; ``<out>_error`` tells why there is none.

    Between two attempts it waits ``wait`` seconds, doubled each time and moved by up to a half either way.
    A null text has neither answer nor error. :func:`mock_model` stands in for a model in tests.
    """

    @F.pandas_udf(f"{out} string, {out}_error string")
    def call(column: pd.Series) -> pd.DataFrame:
        def one(t: str | None) -> tuple[str | None, str | None]:
            told = None
            for turn in range(attempts if t is not None else 0):
                if turn:
                    time.sleep(wait * 2 ** (turn - 1) * random.uniform(0.5, 1.5))
                try:
                    return model(t), None
                except Exception as e:  # noqa: BLE001
                    told = f"{type(e).__name__}: {e}"
            return None, told

        return pd.DataFrame([one(t) for t in column], columns=[out, f"{out}_error"], dtype=object)

    return df.withColumn("_a", call(text)).select(*df.columns, f"_a.{out}", f"_a.{out}_error")


def mock_model(answers: dict[str, str], default: str | None = None) -> Callable[[str], str]:
    """A model that answers from a table, and fails on texts it doesn't hold unless there is a default."""

    def answer(text: str) -> str:
        found = answers.get(text, default)
        if found is None:
            raise LookupError(f"no answer to {text!r}")
        return found

    return answer


def camera_sources(columns: Sequence[str], camera: str, side: str = "left") -> list[str]:
    """The image columns of one camera and side."""
    return [c for c in columns if camera in c and side in c]


def kept_columns(columns: Sequence[str], *unwanted: str) -> list[str]:
    """Columns whose names contain none of the unwanted parts."""
    return [c for c in columns if not any(re.search(re.escape(u), c) for u in unwanted)]
