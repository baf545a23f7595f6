"""Every query of the library beside its SQL in DuckDB, over whole tables."""

import math
from pathlib import Path

import duckdb
import pytest

from reelgrain.plans import catalog

ROOT = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}" if v else "0"
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(ROOT).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, ROOT)
    columns = sorted(df.columns)
    rows = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql:
        out = duck.execute(sql)
        there = [d[0] for d in out.description]
        assert sorted(there) == columns
        assert rows == sorted(repr([plain(r[there.index(c)]) for c in columns]) for r in out.fetchall())


def test_plans_push_down(spark):
    """A query of two columns reads two, and a filter reaches the scan."""
    plan = catalog.queries()["gradient_norm"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double>" in plan
    # (nearest_timestamp, which stood here, now cuts its lineage at sorted rows, so its scan is not in the last plan.)
    plan = catalog.queries()["instruction_default"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "IsNull(error)" in plan.split("PushedFilters: [", 1)[1]


@pytest.mark.parametrize(("name", "columns"), [("p4_found", [("line_id", "bigint")]), ("p5_found", [("index", "bigint"), ("field_name", "string"), ("dim", "int")])])
def test_given_columns(spark, name, columns):
    df = catalog.queries()[name](spark, ROOT)
    assert df.dtypes == columns and df.count() == df.distinct().count() > 0
