"""Every query of the subpackage over whole tables, beside its SQL where it has one."""

from pathlib import Path

import duckdb
import pytest

from reelgrain.llm import catalog

ROOT = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": [("record_id", "bigint"), ("field_name", "string")],
    "p2_found": [("field_name", "string"), ("term", "string"), ("mark", "string")],
    "p3_found": [("base_name", "string"), ("first_second", "int"), ("last_second", "int")],
    "p8_found": [("doc_id", "bigint"), ("item_id", "bigint")],
    "p9_found": [("doc_id", "bigint")],
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(ROOT).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, ROOT)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name] and len(set(rows)) == len(rows)
    if name in catalog.oracle_sql():
        out = duck.execute(catalog.oracle_sql()[name])
        there = [d[0] for d in out.description]
        assert sorted(there) == sorted(df.columns)
        assert sorted(map(repr, rows)) == sorted(repr(tuple(r[there.index(c)] for c in df.columns)) for r in out.fetchall())
