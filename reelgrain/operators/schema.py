"""Columns renamed, dropped, nested and checked by rules; all is decided on the driver from the schema."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def leaves(schema: T.StructType, prefix: str = "") -> dict[str, Column]:
    """Every leaf of a nested schema by its ``/`` path."""
    out: dict[str, Column] = {}

    def walk(kind: T.DataType, path: str, column: Column) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f.dataType, f"{path}/{f.name}", column[f.name])
        else:
            out[path] = column

    for field in schema.fields:
        walk(field.dataType, f"{prefix}{field.name}", F.col(f"`{field.name}`"))
    return out


def nested(paths: Mapping[str, Column]) -> list[Column]:
    """Columns of a nested record from ``/`` paths; a path can't be both a leaf and a node."""
    tree: dict = {}
    for path, column in paths.items():
        node = tree
        *parents, leaf = path.split("/")
        for p in parents:
            node = node.setdefault(p, {})
            if not isinstance(node, dict):
                raise ValueError(f"'{path}' lies below a value")
        if leaf in node:
            raise ValueError(f"'{path}' is both a value and a group" if isinstance(node[leaf], dict) else f"'{path}' already exists in output")
        node[leaf] = column

    def build(node: dict | Column) -> Column:
        return F.struct(*(build(v).alias(k) for k, v in node.items())) if isinstance(node, dict) else node

    return [build(v).alias(k) for k, v in tree.items()]


def flattened(df: DataFrame) -> DataFrame:
    return df.select(*(c.alias(p) for p, c in leaves(df.schema).items()))


def unflattened(df: DataFrame) -> DataFrame:
    return df.select(*nested({c: F.col(f"`{c}`") for c in df.columns}))


def repacked(df: DataFrame, structure: Mapping) -> DataFrame:
    """A new record: a nested mapping whose leaves name the ``/`` paths they are taken from."""
    have = leaves(df.schema)

    def fill(node: Mapping | str) -> Column:
        if isinstance(node, str):
            if node not in have:
                raise KeyError(node)
            return have[node]
        return F.struct(*(fill(v).alias(k) for k, v in node.items()))

    return df.select(*(fill(v).alias(k) for k, v in structure.items()))


def renamed_paths(df: DataFrame, patterns: Mapping[str, str | None]) -> DataFrame:
    """Leaves renamed by the first pattern that matches their whole path (with back-references), or dropped by ``None``.

    Two leaves of one new name are an error; other leaves stay.
    """
    out: dict[str, Column] = {}
    for path, column in leaves(df.schema).items():
        name: str | None = path
        for pattern, to in patterns.items():
            m = re.fullmatch(pattern, path)
            if m:
                name = None if to is None else m.expand(to)
                break
        if name is None:
            continue
        if name in out:
            raise ValueError(f"Key '{name}' already exists in output")
        out[name] = column
    return df.select(*nested(out))


def applied(df: DataFrame, selected: Mapping[str, object], rule: Callable[[Column, object], Column], *, strict: bool = False) -> DataFrame:
    """A rule applied to the columns that ``selected`` names; ``strict``: all of them must be there."""
    missing = [c for c in selected if c not in df.columns]
    if strict and missing:
        raise ValueError(f"columns not found: {', '.join(missing)}")
    return df.withColumns({c: rule(F.col(f"`{c}`"), x) for c, x in selected.items() if c in df.columns})


def with_default(df: DataFrame, name: str, value: object) -> DataFrame:
    """The column, filled where it is null, or made where it is missing."""
    return df.withColumn(name, F.coalesce(F.col(f"`{name}`"), F.lit(value)) if name in df.columns else F.lit(value))


def without_strings(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.StringType)))


def matching(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.fullmatch(pattern, c)]


def first_of(df: DataFrame, names: Sequence[str], out: str) -> DataFrame:
    """The first of several alternative columns that is there and not null."""
    have = [F.col(f"`{n}`") for n in names if n in df.columns]
    if not have:
        raise KeyError(f"none of {', '.join(names)} is there")
    return df.withColumn(out, F.coalesce(*have))


def concatenated(*parts: Column) -> Column:
    """Vectors and single numbers as one vector."""
    return F.concat(*parts)


def camera_columns(df: DataFrame, wanted: Sequence[str], masked: bool) -> DataFrame:
    """Image columns in one struct with a mask each; missing cameras are empty, and masked if ``masked``."""
    images = {n: (F.coalesce(F.col(f"`{n}`"), F.lit(b"")) if n in df.columns else F.lit(b"")) for n in wanted}
    there = {n: (F.lit(True) if n in df.columns else F.lit(not masked)) for n in wanted}
    return df.withColumn("image", F.struct(*(c.alias(n) for n, c in images.items()))).withColumn("image_mask", F.struct(*(c.alias(n) for n, c in there.items())))


def checked_length(v: Column, n: int, name: str) -> Column:
    """The vector, or a failure if it has another length."""
    wrong = F.assert_true(F.size(v) == n, F.concat(F.lit(f"{name}: expected {n} values, got "), F.size(v).cast("string")))
    return F.when(wrong.isNull(), v)


def both_or_neither(a: Column, b: Column, names: str) -> Column:
    return F.assert_true(a.isNull() == b.isNull(), F.lit(f"{names}: both or neither must be given"))


def pruned_features(info: Mapping[str, Mapping], keep: Sequence[str]) -> dict[str, Mapping]:
    """A feature table without the cameras that aren't kept."""
    camera = re.compile(r"observation\.(camera_\d+)\.rgb")
    return {k: v for k, v in info.items() if not (m := camera.fullmatch(k)) or m[1] in keep}
