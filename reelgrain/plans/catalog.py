"""All queries outside the text subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelgrain.plans import curation, dealt, loading, sequences, stats

MODULES = (stats, sequences, curation, loading, dealt)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
