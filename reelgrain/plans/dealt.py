"""Queries of the general problems: repeated deliveries and implausible readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgrain.operators.delivery import deduplicated_lines, surplus_deliveries
from reelgrain.operators.spikes import implausible_readings
from reelgrain.sources.tables import table


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    return surplus_deliveries(table(spark, root, "annotation_lines"))


def p4_kept(spark: SparkSession, root: str) -> DataFrame:
    return deduplicated_lines(table(spark, root, "annotation_lines")).select("line_id", "base_name", "start_second")


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    found = implausible_readings(table(spark, root, "frames"), table(spark, root, "rigs"))
    return found.select("index", "field_name", "dim").distinct()


def p5_reasons(spark: SparkSession, root: str) -> DataFrame:
    """How many readings are flagged, by field and reason."""
    found = implausible_readings(table(spark, root, "frames"), table(spark, root, "rigs"))
    return found.groupBy("field_name", "reason").agg(F.count_distinct("index", "dim").alias("readings"), F.count_distinct("index").alias("frames"))


def p5_limits(spark: SparkSession, root: str) -> DataFrame:
    """The readings that cannot be: not finite, or outside of the rig's limits."""
    found = implausible_readings(table(spark, root, "frames"), table(spark, root, "rigs"))
    return found.filter("reason = 'limit'").select("index", "field_name", "dim").distinct()


QUERIES = {"p4_found": p4_found, "p4_kept": p4_kept, "p5_found": p5_found, "p5_reasons": p5_reasons, "p5_limits": p5_limits}

_CLIP = r"lower(trim(regexp_replace(regexp_replace(trim(base_name, ' ' || chr(9) || chr(10)), '^.*[/\\]', ''), '(.)\.[A-Za-z0-9]{1,5}$', '\1')))"

ORACLE = {
    "p4_found": f"""
        WITH messages AS (SELECT DISTINCT line_id, start_second, {_CLIP} AS clip FROM annotation_lines
                          WHERE base_name IS NOT NULL AND start_second IS NOT NULL),
             placed AS (SELECT line_id, row_number() OVER (PARTITION BY clip, start_second ORDER BY line_id) AS place FROM messages)
        SELECT line_id FROM placed WHERE place > 1""",
    "p4_kept": f"""
        WITH messages AS (SELECT DISTINCT line_id, base_name, start_second, {_CLIP} AS clip FROM annotation_lines),
             placed AS (SELECT *, CASE WHEN clip IS NULL OR start_second IS NULL THEN 1
                                  ELSE row_number() OVER (PARTITION BY clip, start_second ORDER BY line_id) END AS place FROM messages)
        SELECT line_id, base_name, start_second FROM placed WHERE place = 1""",
    "p5_limits": """
        WITH one AS (SELECT index, any_value(source) AS source, any_value("observation.state") AS s, any_value(action) AS a FROM frames WHERE index IS NOT NULL GROUP BY index),
             two AS (SELECT index, 'observation.state' AS field_name, s AS v, state_low AS low, state_high AS high FROM one LEFT JOIN rigs USING (source)
                     UNION ALL SELECT index, 'action', a, action_low, action_high FROM one LEFT JOIN rigs USING (source)),
             flat AS (SELECT index, field_name, generate_subscripts(v, 1) - 1 AS dim, unnest(v) AS x, low, high FROM two)
        SELECT index, field_name, dim::INT AS dim FROM flat WHERE x IS NOT NULL AND (NOT isfinite(x) OR x < low[dim + 1] OR x > high[dim + 1])""",
}
