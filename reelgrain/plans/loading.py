"""Parsing, small merges and numeric rules as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgrain.functions import arrays as A
from reelgrain.functions import parsing as P
from reelgrain.functions import scalars as X
from reelgrain.operators import trees as T
from reelgrain.plans.sequences import _episodes, _frames
from reelgrain.sources.tables import table


def pair_extract(spark: SparkSession, root: str) -> DataFrame:
    text = F.concat(F.lit("Grasp: "), F.col("event_type"), F.lit("; size="), F.col("user_id").cast("string"), F.lit(", rest"))
    return table(spark, root, "events").select("event_id", P.pair(text, ["grasp", "hold"]).alias("grasp"), P.pair(text, ["size"]).alias("size"), P.pair(text, ["none"]).alias("none"))


def json_or_pairs(spark: SparkSession, root: str) -> DataFrame:
    kind = F.col("event_id") % 3
    text = F.when(kind == 0, F.concat(F.lit("so: "), F.col("props"), F.lit(" done"))).when(kind == 1, F.concat(F.lit("first\n**k**: "), F.col("event_type"), F.lit("\nlast"))).otherwise(F.lit("nothing"))
    return table(spark, root, "events").select("event_id", P.json_or_pair(text, "k").alias("k"))


def label_cleanup(spark: SparkSession, root: str) -> DataFrame:
    text = F.concat(F.lit("**I think**\nFinal grasp: `"), F.col("grasp_type"), F.lit("`\nend"))
    rows = table(spark, root, "grasp_records").select("grasp_type").distinct()
    return rows.select("grasp_type", P.plain_label(text).alias("label"), P.labelled(P.plain_label(text), ["Power", "Precision", "Intermediate"]).alias("found"))


def answer_check(spark: SparkSession, root: str) -> DataFrame:
    """Answers of a model, fenced; some are cut off or have notes at wrong starts."""
    shift = F.when(F.col("p_partkey") % 5 == 0, 1).otherwise(0)
    note = lambda i: F.concat(F.lit('{"start": '), (2 * i + shift).cast("string"), F.lit(', "end": '), (2 * i + 2).cast("string"), F.lit(', "left": null, "right": "x"}'))
    body = F.concat(F.lit('```json\n{"summary": "s", "annotations": ['), note(F.lit(0)), F.lit(", "), note(F.lit(1)), F.when(F.col("p_partkey") % 7 == 0, F.lit("")).otherwise(F.lit("]}")), F.lit("\n```"))
    rows = table(spark, root, "part").select("p_partkey", P.answer(body).alias("a"), (F.lit(5) + F.when(F.col("p_partkey") % 4 == 0, 2).otherwise(0)).alias("frames"))
    return rows.select("p_partkey", P.well_formed(F.col("a"), F.col("frames")).alias("good"))


def prefix_rules(spark: SparkSession, root: str) -> DataFrame:
    rules = [("Brand#1", 10), ("Brand#[2-4]$", 20), ("Brand", 30)]
    return table(spark, root, "part").select("p_partkey", P.by_prefix(F.col("p_brand"), rules, 0).cast("bigint").alias("days"))


def text_blocks(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "rigs").select("source", P.block(F.col("source"), ["type", "fps"], [F.col("robot_type"), F.col("fps").cast("string")]).alias("block"))


def instruction_default(spark: SparkSession, root: str) -> DataFrame:
    """Each episode's first annotation, or a standing instruction."""
    notes = table(spark, root, "annotation_lines").filter("error is null").select(X.episode_number(F.col("base_name")).alias("episode_index"), "line_id", "task_description")
    first = notes.groupBy("episode_index").agg(F.min_by("task_description", "line_id").alias("text"))
    return _episodes(spark, root).select("episode_index").distinct().join(first, "episode_index", "left").select("episode_index", F.coalesce("text", F.lit("Do something")).alias("instruction"))


def camera_cut(spark: SparkSession, root: str) -> DataFrame:
    """Frames of each episode before the first whose read failed."""
    steps = _frames(spark, root).select("index", "episode_index", "frame_index")
    reads = _frames(spark, root).filter("index % 211 <> 7").select("episode_index", "frame_index", (F.col("index") % 97 != 5).alias("ok"))
    return T.until_failure(steps, reads, ["episode_index"], "frame_index", "ok").select("index")


def tree_merge(spark: SparkSession, root: str) -> DataFrame:
    reference = table(spark, root, "orders").select(F.concat_ws("/", F.col("o_orderstatus"), F.col("o_orderkey").cast("string")).alias("path"), F.lit(0.0).cast("double").alias("value"))
    loaded = table(spark, root, "orders").filter("o_orderkey % 2 = 0").select(F.concat_ws("/", F.col("o_orderstatus"), F.col("o_orderkey").cast("string")).alias("path"), F.col("o_totalprice").alias("value"))
    return T.merged_tree(reference, loaded, "path", "value", "F/.*")


def arrival_frames(spark: SparkSession, root: str) -> DataFrame:
    rows = T.frame_times(table(spark, root, "events"), ["user_id"], ["ts", "event_id"], F.lit(20.0))
    return rows.select("event_id", "frame_index", F.round("timestamp", 6).alias("timestamp"))


def interpolation(spark: SparkSession, root: str) -> DataFrame:
    v = A.doubles(F.col("embedding"))
    moves = table(spark, root, "embeddings").select("vec_id", F.slice(v, 1, 3).alias("a"), F.slice(v, 4, 3).alias("b"))
    rows = T.interpolated(moves, ["vec_id"], "a", "b", 5)
    return rows.select("vec_id", F.col("step").cast("bigint").alias("step"), F.transform("target", lambda x: F.round(x, 6)).alias("target"))


def numeric_order(spark: SparkSession, root: str) -> DataFrame:
    return T.by_number(table(spark, root, "annotation_lines").select("base_name").distinct(), "base_name")


def newest_checkpoint(spark: SparkSession, root: str) -> DataFrame:
    names = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("tmp_"), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string"))
    return T.newest_number(table(spark, root, "orders").select(names.alias("name")), "name")


def divisible_axis(spark: SparkSession, root: str) -> DataFrame:
    shape = F.array(F.col("p_size"), F.col("p_partkey").cast("int") % 64 + 1, F.lit(12))
    return table(spark, root, "part").select("p_partkey", T.split_axis(shape, 4).cast("bigint").alias("axis"))


def vocabulary_remap(spark: SparkSession, root: str) -> DataFrame:
    """Action tokens at the end of a vocabulary, counted from its last ones."""
    return table(spark, root, "orders").select("o_orderkey", X.action_token(F.col("o_custkey") % 1024, 257_152).alias("token"))


def token_values(spark: SparkSession, root: str) -> DataFrame:
    tokens = F.transform(A.doubles(F.col("embedding")), lambda x: F.floor((x + 1) * 512).cast("int"))
    steps = A.reshape(A.undigitize(tokens, 1024), 4, 16)
    return table(spark, root, "embeddings").select("vec_id", F.transform(steps, lambda s: F.transform(s, lambda x: F.round(x, 6))).alias("steps"))


def clipped_actions(spark: SparkSession, root: str) -> DataFrame:
    """Values in [-1, 1], the last one as open or closed."""
    v = F.slice(F.transform(A.doubles(F.col("embedding")), lambda x: x * 5), 1, 8)
    out = F.transform(v, lambda x, i: F.when(i == 7, F.when(x > 0.5, 1.0).otherwise(0.0)).otherwise(A.clip(x, -1.0, 1.0)))
    return table(spark, root, "embeddings").select("vec_id", F.transform(out, lambda x: F.round(x, 6)).alias("action"))


def image_scaling(spark: SparkSession, root: str) -> DataFrame:
    """Bytes to [-1, 1] and back."""
    rows = table(spark, root, "part").select("p_partkey", (F.col("p_size") % 256).alias("b"))
    return rows.select("p_partkey", F.round(X.byte_to_unit(F.col("b")), 6).alias("scaled"), X.unit_to_byte(X.byte_to_unit(F.col("b"))).alias("back"))


def best_reward(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").groupBy("user_id").agg(F.max("value").alias("best"))


def frames_per_source(spark: SparkSession, root: str) -> DataFrame:
    """Episodes, frames, tasks and chunks of each source, as a dataset's description has them."""
    rows = _frames(spark, root).groupBy("source").agg(F.count_distinct("episode_index").alias("episodes"), F.count("*").alias("frames"), F.count_distinct("task_index").alias("tasks"))
    return rows.withColumn("chunks", F.greatest(F.ceil(F.col("episodes") / 1000), F.lit(1)).cast("bigint"))


def hash_choice(spark: SparkSession, root: str) -> DataFrame:
    """One of three instructions per order, the same in every run."""
    names = [F.col("o_orderpriority"), F.col("o_orderstatus"), F.lit("do it")]
    return table(spark, root, "orders").select("o_orderkey", P.one_of(names, "o_orderkey").alias("instruction"))


def grasp_query(spark: SparkSession, root: str) -> DataFrame:
    """Free-text queries made of analysed hands, read back field by field and held against the hand."""
    h = table(spark, root, "sequential_seconds").select("base_name", "second", F.explode("analysis.hands").alias("hand", "h")).distinct()
    said = F.concat(F.lit("Opposition: "), F.coalesce("h.opposition_type", F.lit("none")), F.lit("\nOBJECT SHAPE: "), F.coalesce("h.object_shape", F.lit("unknown")), F.lit("\n"))
    rows = h.select("base_name", "second", "hand", "h", said.alias("said"))
    shape = P.query_field(F.col("said"), "shape")
    fits = P.agrees(P.query_field(F.col("said"), "opposition"), F.col("h.opposition_type")) & P.overlaps(shape, F.col("h.object_shape"))
    return rows.select("base_name", "second", "hand", P.query_field(F.col("said"), "opposition").alias("opposition"), shape.alias("shape"), fits.alias("fits"), P.mentions(F.col("said"), [F.col("h.opposition_type"), F.col("h.object_shape"), F.col("h.grasp_type")]).alias("score"))


def inverse_root_rate(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select("o_orderkey", F.round(X.warmup_inverse_root(F.col("o_orderkey"), 1000, 1.0, 10_000.0), 8).alias("rate"))


QUERIES = {
    f.__name__: f
    for f in (
        pair_extract, json_or_pairs, label_cleanup, answer_check, prefix_rules, text_blocks, instruction_default, camera_cut, tree_merge, arrival_frames, interpolation, numeric_order, newest_checkpoint, divisible_axis,
        vocabulary_remap, token_values, clipped_actions, image_scaling, best_reward, frames_per_source, hash_choice, grasp_query, inverse_root_rate,
    )
}

_FRAMES = "one AS (SELECT index, any_value(episode_index) AS episode_index, any_value(frame_index) AS frame_index, any_value(source) AS source, any_value(task_index) AS task_index FROM frames GROUP BY index)"

ORACLE = {
    "pair_extract": "SELECT event_id, lower(event_type) AS grasp, user_id::VARCHAR AS size, NULL::VARCHAR AS none FROM events",
    "json_or_pairs": "SELECT event_id, CASE event_id % 3 WHEN 0 THEN props::JSON ->> '$.k' WHEN 1 THEN event_type ELSE 'Unknown' END AS k FROM events",
    "label_cleanup": r"""WITH d AS (SELECT DISTINCT grasp_type FROM grasp_records), c AS (SELECT grasp_type, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(grasp_type, '[*`]', '', 'g'), '(^|\W)_+', '\1', 'g'), '_+($|\W)', '\1', 'g'), '[‐‑‒–—]', '-', 'g'), '\s+', ' ', 'g')) AS label FROM d)
        SELECT grasp_type, label, coalesce(nullif(regexp_extract(label, '(?i)\b((?:Power|Precision|Intermediate)\s*:\s*[A-Za-z_ ]+[A-Za-z])', 1), ''), nullif(regexp_extract(label, '(?i)\b(Power|Precision|Intermediate)\b', 1), '')) AS found FROM c""",
    "answer_check": "SELECT p_partkey, p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 AND p_partkey % 4 <> 0 AS good FROM part",
    "prefix_rules": "SELECT p_partkey, (CASE WHEN p_brand LIKE 'Brand#1%' THEN 10 WHEN p_brand IN ('Brand#2', 'Brand#3', 'Brand#4') THEN 20 ELSE 30 END)::BIGINT AS days FROM part",
    "text_blocks": "SELECT source, source || chr(10) || '- type: ' || coalesce(robot_type, 'none') || chr(10) || '- fps: ' || coalesce(fps::VARCHAR, 'none') AS block FROM rigs",
    "instruction_default": """WITH n AS (SELECT coalesce(try_cast(nullif(regexp_extract(base_name, '([0-9]+)', 1), '') AS BIGINT), -1) AS episode_index, arg_min(task_description, line_id) AS text FROM annotation_lines WHERE error IS NULL GROUP BY 1),
        e AS (SELECT DISTINCT episode_index FROM episodes) SELECT episode_index, coalesce(text, 'Do something') AS instruction FROM e LEFT JOIN n USING (episode_index)""",
    "camera_cut": f"WITH {_FRAMES}, f AS (SELECT *, min(CASE WHEN index % 211 = 7 OR index % 97 = 5 THEN frame_index END) OVER (PARTITION BY episode_index) AS bad FROM one) SELECT index FROM f WHERE bad IS NULL OR frame_index < bad",
    "tree_merge": "SELECT o_orderstatus || '/' || o_orderkey AS path, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice ELSE 0.0 END AS value FROM orders WHERE o_orderkey % 2 = 0 OR o_orderstatus = 'F'",
    "arrival_frames": "WITH f AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame_index FROM events) SELECT event_id, frame_index, round(frame_index / 20.0::DOUBLE, 6) AS timestamp FROM f",
    "interpolation": "WITH s AS (SELECT vec_id, embedding, unnest(range(5)) AS step FROM embeddings) SELECT vec_id, step, list_transform(range(1, 4), lambda i: round(embedding[i]::DOUBLE + (embedding[i + 3]::DOUBLE - embedding[i]::DOUBLE) * step / 4.0::DOUBLE, 6)) AS target FROM s",
    "numeric_order": "SELECT DISTINCT base_name, coalesce(try_cast(nullif(regexp_extract(base_name, '([0-9]+)', 1), '') AS BIGINT), -1) AS number FROM annotation_lines",
    "newest_checkpoint": "SELECT max(o_orderkey) AS newest FROM orders WHERE o_orderkey % 3 <> 0",
    "divisible_axis": """WITH s AS (SELECT p_partkey, [p_size, p_partkey % 64 + 1, 12] AS s FROM part), d AS (SELECT p_partkey, unnest(s) AS n, unnest([0, 1, 2]) AS i FROM s)
        SELECT p_partkey, coalesce(arg_min(i, (-n, i)) FILTER (WHERE n % 4 = 0), -1)::BIGINT AS axis FROM d GROUP BY 1""",
    "vocabulary_remap": "SELECT o_orderkey, 257152 - 1 - 128 - o_custkey % 1024 AS token FROM orders",
    "token_values": "SELECT vec_id, list_transform(range(4), lambda i: list_transform(range(1, 17), lambda j: round(floor((embedding[i * 16 + j]::DOUBLE + 1) * 512) / 1024.0::DOUBLE * 2 - 1, 6))) AS steps FROM embeddings",
    "clipped_actions": "SELECT vec_id, list_transform(embedding[1:8], lambda x, i: round(CASE WHEN i = 8 THEN CASE WHEN x::DOUBLE * 5 > 0.5 THEN 1.0 ELSE 0.0 END ELSE greatest(-1.0, least(1.0, x::DOUBLE * 5)) END, 6)) AS action FROM embeddings",
    "image_scaling": "SELECT p_partkey, round((p_size % 256) / 255.0::DOUBLE * 2 - 1, 6) AS scaled, (p_size % 256)::BIGINT AS back FROM part",
    "best_reward": "SELECT user_id, max(value) AS best FROM events GROUP BY user_id",
    "inverse_root_rate": "SELECT o_orderkey, round(CASE WHEN o_orderkey < 1000 THEN (o_orderkey + 1) / 1001.0::DOUBLE ELSE 1 / sqrt((10000 + o_orderkey - 1000) / 10000.0::DOUBLE) END, 8) AS rate FROM orders",
    "grasp_query": r"""WITH h AS (SELECT DISTINCT base_name, second, unnest(map_keys(analysis.hands)) AS hand, unnest(map_values(analysis.hands)) AS h FROM sequential_seconds WHERE analysis IS NOT NULL),
        s AS (SELECT *, 'opposition: ' || lower(coalesce(h.opposition_type, 'none')) || chr(10) || 'object shape: ' || lower(coalesce(h.object_shape, 'unknown')) || chr(10) AS said FROM h),
        p AS (SELECT *, trim(regexp_extract(said, 'opposition\s*:\s*(palm|pad|side)', 1)) AS o, regexp_replace(regexp_extract(said, 'object shape\s*:\s*([a-z0-9\-\s/]+)', 1), '^\s+|\s+$', '', 'g') AS w FROM s)
        SELECT base_name, second, hand, o AS opposition, w AS shape,
            (o IN ('', 'unknown') OR coalesce(lower(h.opposition_type) = o, false)) AND (w IN ('', 'unknown', 'error') OR len(list_filter(string_split_regex(w, '[,/]'), lambda q: len(list_filter(string_split_regex(lower(coalesce(h.object_shape, '')), '[,/]'), lambda k: contains(trim(k), trim(q)) OR contains(trim(q), trim(k)))) > 0)) > 0) AS fits,
            coalesce((h.opposition_type <> '' AND contains(said, lower(h.opposition_type)))::BIGINT, 0) + coalesce((h.object_shape <> '' AND contains(said, lower(h.object_shape)))::BIGINT, 0) + coalesce((h.grasp_type <> '' AND contains(said, lower(h.grasp_type)))::BIGINT, 0) AS score FROM p""",
    "hash_choice": "SELECT o_orderkey, [o_orderpriority, o_orderstatus, 'do it'][('0x' || substr(md5(o_orderkey::VARCHAR), 1, 15))::BIGINT % 3 + 1] AS instruction FROM orders",
    "frames_per_source": f"WITH {_FRAMES} SELECT source, count(DISTINCT episode_index) AS episodes, count(*) AS frames, count(DISTINCT task_index) AS tasks, greatest(ceil(count(DISTINCT episode_index) / 1000.0), 1)::BIGINT AS chunks FROM one GROUP BY source",
}
