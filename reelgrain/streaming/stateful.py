"""Keyed state over streams: chunk brokers, episode buffers, latency carried to the next request."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def broker(df: DataFrame, key: str, order: str, chunk: str, every: int) -> DataFrame:
    """Per key, one value of the chunk in use for each request; after ``every`` values the request's own chunk is taken.

    ``chunk`` holds arrays of doubles; rows of one micro-batch are served in ``order``.
    """

    def serve(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, step = state.get if state.exists else ([], every)
        held = list(held)
        rows = pd.concat(list(batches)).sort_values(order)
        out = []
        for at, own in zip(rows[order], rows[chunk]):
            if step >= every:
                held, step = [float(x) for x in own], 0
            out.append((keys[0], at, held[step] if step < len(held) else None))
            step += 1
        state.update((held, step))
        yield pd.DataFrame(out, columns=[key, order, "emitted"])

    schema = f"{key} {df.schema[key].dataType.simpleString()}, {order} {df.schema[order].dataType.simpleString()}, emitted double"
    return df.groupBy(key).applyInPandasWithState(serve, schema, "held array<double>, step int", "append", GroupStateTimeout.NoTimeout)


def episodes(df: DataFrame, key: str, order: str, value: str, end: str) -> DataFrame:
    """Frames are buffered per key; a frame whose ``end`` is true closes the episode and hands it on."""

    def buffer(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        values, number = state.get if state.exists else ([], 0)
        values, out = list(values), []
        for v, last in pd.concat(list(batches)).sort_values(order)[[value, end]].itertuples(index=False):
            values.append(float(v))
            if last:
                out.append((keys[0], number, len(values), values))
                values, number = [], number + 1
        state.update((values, number))
        yield pd.DataFrame(out, columns=[key, "episode", "length", "values"])

    schema = f"{key} {df.schema[key].dataType.simpleString()}, episode int, length int, values array<double>"
    return df.groupBy(key).applyInPandasWithState(buffer, schema, "values array<double>, number int", "append", GroupStateTimeout.NoTimeout)


def with_previous(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Each request with the value of the key's request before, across micro-batches."""

    def carry(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(order)
        values = rows[value].astype(float).tolist()
        yield pd.DataFrame({key: keys[0], order: rows[order], value: values, "previous": [before, *values[:-1]]})
        state.update((values[-1],))

    schema = f"{key} {df.schema[key].dataType.simpleString()}, {order} {df.schema[order].dataType.simpleString()}, {value} double, previous double"
    return df.groupBy(key).applyInPandasWithState(carry, schema, "before double", "append", GroupStateTimeout.NoTimeout)
