"""Queries over whole tables, held against code of their own."""

import math
import re

import duckdb

from reelgrain.plans import catalog

ROOT = "/root/testdata/sf0.01"


def test_range_key_lookup_reads_all_orders(spark):
    rows = duckdb.sql(f"SELECT o_orderkey, o_custkey, o_orderpriority FROM '{ROOT}/orders.parquet' WHERE o_orderkey % 7 <> 0 ORDER BY o_orderkey").fetchall()
    want = {}
    for key, customer, info in rows:
        a, b = key * 37 % 500, (key * 37 + customer % 11 - 5) % 500
        want |= dict.fromkeys(range(min(a, b), max(a, b) + 1), info)
    assert {r["number"]: r["info"] for r in catalog.queries()["range_key_lookup"](spark, ROOT).collect()} == want


def test_annotation_update_reads_all_spellings(spark):
    lines = duckdb.sql(f"SELECT base_name, coalesce(start_second, -1), line_id, task_description FROM '{ROOT}/annotation_lines.parquet' WHERE error IS NULL AND base_name IS NOT NULL AND task_description IS NOT NULL").fetchall()
    first = {}
    for name, start, line, text in sorted(lines, key=lambda r: r[1:3]):
        stem = name.strip().replace("\\", "/").rpartition("/")[2].lower().partition(".")[0].strip()
        first.setdefault(int(stem.removeprefix("episode_")), [text])
    episodes = duckdb.sql(f"SELECT DISTINCT episode_index, tasks FROM '{ROOT}/episodes.parquet'").fetchall()
    got = {r["episode_index"]: r["tasks"] for r in catalog.queries()["annotation_update"](spark, ROOT).collect()}
    assert got == {e: first.get(e, tasks) for e, tasks in episodes}


def test_label_cleanup_reads_all_labels(spark):
    labels = [r[0] for r in duckdb.sql(f"SELECT DISTINCT grasp_type FROM '{ROOT}/grasp_records.parquet'").fetchall()]
    got = {r["grasp_type"]: (r["label"], r["found"]) for r in catalog.queries()["label_cleanup"](spark, ROOT).collect()}
    assert got.keys() == set(labels)
    for text in filter(None, labels):
        label = " ".join(re.sub("[*`]", "", text).split())
        both = re.search(r"\b(?:power|precision|intermediate)\s*:\s*[a-z_ ]*[a-z]", label, re.I) or re.search(r"\b(?:power|precision|intermediate)\b", label, re.I)
        assert got[text] == (label, both and both[0])


def test_norm_stats_rigs_reads_all_finite_readings(spark):
    rows = duckdb.sql(f"""SELECT source, any_value("observation.state") FROM '{ROOT}/frames.parquet' GROUP BY index, source""").fetchall()
    values = {}
    for source, vector in rows:
        for dim, x in enumerate(vector or []):
            if x is not None and math.isfinite(x):
                values.setdefault((source, dim), []).append(x)
    got = {(r["source"], r["dim"]): (r["n"], r["low"], r["high"]) for r in catalog.queries()["norm_stats_rigs"](spark, ROOT).collect() if r["field_name"] == "observation.state"}
    assert got == {k: (len(v), round(min(v), 4), round(max(v), 4)) for k, v in values.items()}
    assert any(abs(x) >= 1e6 for v in values.values() for x in v)
