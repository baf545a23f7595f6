"""Queries of the text and sequence problems, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgrain.llm.abuse import abuse_scores, source_rates
from reelgrain.llm.event_runs import event_runs
from reelgrain.llm.frequency import marked_terms
from reelgrain.llm.leakage import leaked_items, without_leaks
from reelgrain.llm.packing import fill_report, kept_promises, packed
from reelgrain.llm.percentiles import all_percentiles, within_bound
from reelgrain.llm.residue import residue, without_residue
from reelgrain.sources.tables import table

RESIDUE_FIELDS = ("grasp_type", "description")
#: From this score on a document counts as abusive.
ABUSIVE = 0.5
TERM_FIELDS = ("grasp_type", "object_name", "affordance")


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return residue(table(spark, root, "grasp_records"), RESIDUE_FIELDS).select("record_id", "field_name").distinct()


def p1_kept(spark: SparkSession, root: str) -> DataFrame:
    """The records that stay after the exclusion."""
    return without_residue(table(spark, root, "grasp_records"), RESIDUE_FIELDS).select("record_id").distinct()


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """The single terms among all runs of terms that stand next to each other."""
    return marked_terms(table(spark, root, "grasp_records"), TERM_FIELDS).filter("length = 1 and mark is not null").select("field_name", "term", "mark")


def p2_terms(spark: SparkSession, root: str) -> DataFrame:
    """Every term with its occurrences and records."""
    return marked_terms(table(spark, root, "grasp_records"), TERM_FIELDS).filter("length = 1").drop("length")


def p2_runs(spark: SparkSession, root: str) -> DataFrame:
    """Runs of up to three terms that stand next to each other in a cell."""
    runs = marked_terms(table(spark, root, "grasp_records"), TERM_FIELDS)
    return runs.select("field_name", F.col("term").alias("terms"), F.col("length").cast("bigint").alias("length"), "occurrences", "records")


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    return event_runs(table(spark, root, "sequential_seconds")).filter("seconds > 1").select("base_name", "first_second", "last_second")


def p3_events(spark: SparkSession, root: str) -> DataFrame:
    """Every event once, with its count and duration."""
    return event_runs(table(spark, root, "sequential_seconds"))


def p6_percentiles(spark: SparkSession, root: str) -> DataFrame:
    return all_percentiles(table(spark, root, "frames"), table(spark, root, "episodes"), table(spark, root, "rigs"))


def p6_within(spark: SparkSession, root: str) -> DataFrame:
    """Whether the percentiles of every channel keep the stated bound."""
    frames = table(spark, root, "frames")
    return within_bound(frames, all_percentiles(frames, table(spark, root, "episodes"), table(spark, root, "rigs")))


def p7_containers(spark: SparkSession, root: str) -> DataFrame:
    return packed(table(spark, root, "documents"), table(spark, root, "pack_targets"))


def p7_fill(spark: SparkSession, root: str) -> DataFrame:
    """How many containers each target needs, beside the fewest possible."""
    return fill_report(packed(table(spark, root, "documents"), table(spark, root, "pack_targets")))


def p7_promises(spark: SparkSession, root: str) -> DataFrame:
    """What must hold of the containers of each target."""
    documents = table(spark, root, "documents")
    return kept_promises(documents, packed(documents, table(spark, root, "pack_targets")))


def p8_found(spark: SparkSession, root: str) -> DataFrame:
    return leaked_items(table(spark, root, "documents"), table(spark, root, "eval_items")).select("doc_id", "item_id")


def p8_items(spark: SparkSession, root: str) -> DataFrame:
    """By item, how many documents hold it, and how much of it at most."""
    found = leaked_items(table(spark, root, "documents"), table(spark, root, "eval_items"))
    return found.groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words").alias("most_words"))


def p8_cleaned(spark: SparkSession, root: str) -> DataFrame:
    """How much is left of each document that held a leak; those that consist of leaks to more than a half are left out."""
    kept = without_leaks(table(spark, root, "documents"), table(spark, root, "eval_items"))
    return kept.filter("cut_words > 0").select("doc_id", "cut_words", "words")


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    scores = abuse_scores(table(spark, root, "documents"), table(spark, root, "review_labels"))
    return scores.filter(F.col("score") >= ABUSIVE).select("doc_id").distinct()


def p9_scores(spark: SparkSession, root: str) -> DataFrame:
    """Every document with the score of its worst passage."""
    return abuse_scores(table(spark, root, "documents"), table(spark, root, "review_labels"))


def p9_rates(spark: SparkSession, root: str) -> DataFrame:
    """The share of abusive documents by source."""
    return source_rates(abuse_scores(table(spark, root, "documents"), table(spark, root, "review_labels")), ABUSIVE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (p1_found, p1_kept, p2_found, p2_terms, p2_runs, p3_found, p3_events, p6_percentiles, p6_within, p7_containers, p7_fill, p7_promises, p8_found, p8_items, p8_cleaned, p9_found, p9_scores, p9_rates)
    return {f.__name__: f for f in found}


_CELLS = """cells AS (
    SELECT DISTINCT record_id, grasp_type, object_name, affordance FROM grasp_records WHERE record_id IS NOT NULL),
  fields AS (
    SELECT record_id, 'grasp_type' AS field_name, grasp_type AS cell, row_number() OVER () AS cell_no FROM cells
    UNION ALL SELECT record_id, 'object_name', object_name, row_number() OVER () FROM cells
    UNION ALL SELECT record_id, 'affordance', affordance, row_number() OVER () FROM cells),
  parts AS (
    SELECT record_id, field_name, cell_no,
           list_filter(list_transform(string_split(cell, ';'), lambda p: trim(regexp_replace(replace(lower(p), '_', ' '), '\\s+', ' ', 'g'))), lambda t: t <> '') AS terms
    FROM fields WHERE cell IS NOT NULL)"""

_MARKED = f"""WITH {_CELLS},
  split AS (SELECT record_id, field_name, unnest(terms) AS term FROM parts),
  counted AS (SELECT field_name, term, count(*) AS occurrences, count(DISTINCT record_id) AS records FROM split GROUP BY ALL),
  marked AS (SELECT *, CASE WHEN records < 3 THEN 'rare' WHEN records > 0.1 * (SELECT count(DISTINCT record_id) FROM grasp_records) THEN 'common' END AS mark FROM counted)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p6_within": """WITH one AS (SELECT index, any_value(source) AS source, any_value("observation.state") AS s, any_value(action) AS a FROM frames WHERE index IS NOT NULL GROUP BY index),
  two AS (SELECT source, 'observation.state' AS field_name, s AS v FROM one UNION ALL SELECT source, 'action', a FROM one),
  flat AS (SELECT source, field_name, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS dim FROM two)
  SELECT source, field_name, dim, count(*) AS n, true AS kept FROM flat WHERE isfinite(x) GROUP BY ALL""",
        "p7_promises": """SELECT target_name, max(capacity_tokens) AS capacity, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0::BIGINT AS missing, 0::BIGINT AS overfull, 0::BIGINT AS split, true AS near_fewest
  FROM pack_targets WHERE target_name IS NOT NULL AND capacity_tokens > 0 GROUP BY target_name""",
        "p2_found": f"{_MARKED} SELECT field_name, term, mark FROM marked WHERE mark IS NOT NULL",
        "p2_terms": f"{_MARKED} SELECT field_name, term, occurrences, records, mark FROM marked",
        "p2_runs": f"""WITH {_CELLS},
  starts AS (SELECT record_id, field_name, terms, unnest(range(1, len(terms) + 1)) AS i FROM parts WHERE len(terms) > 0),
  runs AS (SELECT record_id, field_name, terms, i, unnest(range(1, least(3, len(terms) - i + 1) + 1)) AS length FROM starts)
  SELECT field_name, array_to_string(terms[i : i + length - 1], '; ') AS terms, length, count(*) AS occurrences, count(DISTINCT record_id) AS records
  FROM runs GROUP BY field_name, array_to_string(terms[i : i + length - 1], '; '), length""",
    }
