"""Segments and annotations, look-ups, sampling, metrics, windows and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelgrain.functions import arrays as A
from reelgrain.functions import scalars as X
from reelgrain.operators import brokers, metrics, retrieval, sampling, segments
from reelgrain.plans.sequences import _episodes, _frames, _signal
from reelgrain.sources.tables import table
from reelgrain.streaming import windows


def _seconds(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "sequential_seconds")


def segment_sessions(spark: SparkSession, root: str) -> DataFrame:
    return segments.sessions(_seconds(spark, root), ["base_name"], "second")


def segment_split_long(spark: SparkSession, root: str) -> DataFrame:
    return segments.split_long(segments.sessions(_seconds(spark, root), ["base_name"], "second"), 10).select("base_name", "start", "end")


def segment_frame_bounds(spark: SparkSession, root: str) -> DataFrame:
    rows = segments.sessions(_seconds(spark, root), ["base_name"], "second")
    a, b = segments.frame_bounds(F.col("start") - 1, F.col("end"), F.lit(30), F.lit(400).cast("bigint"))
    return rows.select("base_name", a.alias("first"), b.alias("last")).filter("first < last")


def frame_linspace_sample(spark: SparkSession, root: str) -> DataFrame:
    return _episodes(spark, root).select("episode_index", A.linspace(F.lit(0).cast("bigint"), F.col("length") - 1, 15).alias("frames"))


def frame_round_sample(spark: SparkSession, root: str) -> DataFrame:
    return _episodes(spark, root).select("episode_index", A.linspace_rounded(F.col("length"), 9).alias("frames"))


def second_triples(spark: SparkSession, root: str) -> DataFrame:
    return segments.second_triples(_episodes(spark, root).select("episode_index", "length"), ["episode_index"], "length")


def video_chunk_ranges(spark: SparkSession, root: str) -> DataFrame:
    rows = segments.frame_chunks(_episodes(spark, root).select("episode_index", "length", F.lit(20.0).cast("double").alias("fps")), ["episode_index"], "length", 64, "fps")
    return rows.select("episode_index", "chunk", "start", "end", F.round("at", 6).alias("at"))


def _lines(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "annotation_lines")


def per_second_shift(spark: SparkSession, root: str) -> DataFrame:
    notes = F.split(F.col("task_description"), " ")
    rows = _lines(spark, root).filter("base_name is not null and start_second is not null and task_description is not null").withColumn("notes", notes)
    return segments.per_second(rows, "base_name", "start_second", "notes", ["line_id", "batch_id"])


def resume_antijoin(spark: SparkSession, root: str) -> DataFrame:
    """Lines without an answer whose clip and start no answered line covers."""
    lines = _lines(spark, root)
    done = lines.filter("error is null")
    return segments.outstanding(lines.filter("error is not null").select("base_name", "start_second").distinct(), done, ["base_name", "start_second"])


def error_rules(spark: SparkSession, root: str) -> DataFrame:
    """Lines that count as answered by the two rules: no error at all, and no error text."""
    e = F.col("error")
    return _lines(spark, root).agg(F.count_if(e.isNull()).alias("no_error"), F.count_if(F.coalesce(e, F.lit("")) == "").alias("no_text"), F.count("*").alias("lines"))


def collect_segments(spark: SparkSession, root: str) -> DataFrame:
    rows = segments.collected(_lines(spark, root).filter("base_name is not null and start_second is not null and error is null").select("base_name", "start_second", "line_id"), "base_name", ["start_second", "line_id"], [])
    return rows.select("base_name", F.transform("segments", lambda s: s["line_id"]).alias("lines"))


def range_key_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Key ranges as text, made of orders: overlapping, reversed and commented lines among them."""
    text = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("# "), F.col("o_orderpriority"))).otherwise(
        F.concat_ws("", F.pmod(F.col("o_orderkey") * 37, F.lit(500)).cast("string"), F.lit("-"), F.pmod(F.col("o_orderkey") * 37 + F.col("o_custkey") % 11 - 5, F.lit(500)).cast("string"), F.lit(": "), F.col("o_orderpriority"))
    )
    lines = table(spark, root, "orders").select(F.col("o_orderkey").alias("line"), text.alias("value"))
    return segments.range_info(segments.key_ranges(lines))


def annotation_progress(spark: SparkSession, root: str) -> DataFrame:
    per_clip = _lines(spark, root).groupBy("base_name").agg(F.count_if(F.col("error").isNull()).alias("n"), F.count("*").alias("target"))
    return segments.progress(per_clip)


def active_hands(spark: SparkSession, root: str) -> DataFrame:
    """Seconds by the set of hands named; none counts as the right one."""
    hands = F.array_sort(F.array_distinct(F.transform(F.coalesce("analysis.active_hands", F.array().cast("array<string>")), F.lower)))
    named = F.when(F.size(hands) > 0, hands).otherwise(F.array(F.lit("right")))
    return _seconds(spark, root).select(F.array_join(named, "+").alias("hands")).groupBy("hands").agg(F.count("*").alias("seconds"))


def hand_entries(spark: SparkSession, root: str) -> DataFrame:
    """Analyses flattened to one row per hand, counted by grasp."""
    rows = _seconds(spark, root).select(F.explode("analysis.hands").alias("hand", "h"))
    return rows.groupBy(F.lower("hand").alias("hand"), F.col("h.grasp_type").alias("grasp_type")).agg(F.count("*").alias("entries"), F.count_if(F.col("h.object_shape").isNull()).alias("shapeless"))


def distinct_tasks(spark: SparkSession, root: str) -> DataFrame:
    return _episodes(spark, root).select("source", F.explode("tasks").alias("task")).groupBy("source").agg(F.array_sort(F.collect_set("task")).alias("tasks"))


def nearest_timestamp(spark: SparkSession, root: str) -> DataFrame:
    """For each error event the other event of its user that is nearest in time."""
    e = table(spark, root, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    queries = e.filter("event_type = 'error'").select("user_id", F.col("us").alias("at"), F.col("event_id").alias("query_id"))
    data = e.filter("event_type <> 'error'").select("user_id", "us", "event_id")
    found = retrieval.nearest(queries, data, ["user_id"], "at", "us", "event_id", 3.6e9)
    return found.select("query_id", "event_id", "late")


def frame_index_round(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "part").select("p_partkey", X.frame_at(F.col("p_retailprice") / 16, F.lit(8), F.lit(600).cast("bigint")).alias("frame"))
    return rows


def _grasps(spark: SparkSession, root: str) -> DataFrame:
    h = _seconds(spark, root).select(F.explode("analysis.hands").alias("hand", "h")).select("h.*")
    return h.filter("grasp_type is not null")


_FEATURES = ("grasp_category", "opposition_type", "thumb_position", "virtual_fingers")


def kb_tiered_topk(spark: SparkSession, root: str) -> DataFrame:
    grasps = _grasps(spark, root)
    entries = grasps.groupBy(F.col("grasp_type").alias("name")).agg(*(F.min(c).alias(f"e_{c}") for c in _FEATURES)).withColumn("pos", F.col("name"))
    queries = grasps.groupBy(*_FEATURES).agg(F.count("*").alias("n")).withColumn("query", F.concat_ws("|", *_FEATURES))
    rows = retrieval.tiered_top(queries, entries, [(c, f"e_{c}") for c in _FEATURES], [[0, 1, 2], [0, 1], [0]], "query", "name", "pos", 3)
    return rows.select("query", "name", F.col("tier").cast("bigint").alias("tier"), "score", F.col("rank").cast("bigint").alias("rank"))


def confuser_selfjoin(spark: SparkSession, root: str) -> DataFrame:
    rigs = table(spark, root, "rigs").select("source", "robot_type", F.size("state_low").alias("width"))
    return retrieval.same_signature(rigs, "source", ["robot_type", "width"])


def causal_mask_counts(spark: SparkSession, root: str) -> DataFrame:
    tokens = _signal(spark, root).select("event_id", "user_id", "frame", (F.col("event_id") % 3 == 0).cast("int").alias("step"), (F.col("value") < 90).alias("valid"))
    rows = retrieval.attended(tokens, "user_id", "frame", "step", "valid")
    return rows.select("user_id", "frame", "attended")


def block_mask_counts(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").filter("p_size > 0").select("p_partkey", retrieval.block_pairs(F.col("p_size").cast("bigint"), 2, 3).alias("pairs"))


def fuzzy_label(spark: SparkSession, root: str) -> DataFrame:
    allowed = ("wide wrap", "hook hold", "full palm", "thumb side", "two finger pinch", "three finger tip", "four finger edge", "key hold", "ball cage", "rim clasp", "nail pick", "disk spread")
    labels = table(spark, root, "grasp_records").select(X.clean_label(F.element_at(F.split("grasp_type", ":"), -1)).alias("label"))
    return retrieval.closest_name(labels, "label", allowed)


def stride_shard(spark: SparkSession, root: str) -> DataFrame:
    return sampling.shard(table(spark, root, "events").select("ts", "event_id"), ["ts", "event_id"], 8, 3).select("event_id")


def batch_rows(spark: SparkSession, root: str) -> DataFrame:
    rows = sampling.batches(table(spark, root, "orders").select("o_orderkey"), ["o_orderkey"], 64)
    return rows.groupBy("batch").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))


def batch_cycle(spark: SparkSession, root: str) -> DataFrame:
    return sampling.batches(table(spark, root, "supplier").select("s_suppkey"), ["s_suppkey"], 16, 40).select("s_suppkey", "batch", "slot")


def weighted_mix(spark: SparkSession, root: str) -> DataFrame:
    rows = sampling.mixed(table(spark, root, "events").select("event_id", "event_type"), "event_type", ["event_id"], {"click": 0.5, "error": 0.3, "purchase": 0.2}, 9000, 5)
    return rows.groupBy("event_type").agg(F.count("*").alias("rows"))


def shuffle_hash(spark: SparkSession, root: str) -> DataFrame:
    return sampling.shuffled(table(spark, root, "events").select("event_id"), ["event_id"], 11)


def random_subset(spark: SparkSession, root: str) -> DataFrame:
    """The operator is a sample: a thousand rows by hash."""
    return sampling.subset(table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber", "l_partkey"], 1000, 5)


def checkpoint_retention(spark: SparkSession, root: str) -> DataFrame:
    return sampling.retained(table(spark, root, "orders").select(F.col("o_orderkey").alias("step")), "step", 1000)


def latency_profile(spark: SparkSession, root: str) -> DataFrame:
    rows = metrics.profile(table(spark, root, "events"), ["event_type"], "value")
    return rows.select("event_type", *(F.round(c, 6).alias(c) for c in rows.columns if c != "event_type"))


def success_rate(spark: SparkSession, root: str) -> DataFrame:
    return metrics.success_rate(table(spark, root, "events"), ["user_id"], F.col("event_type") != "error").withColumn("rate", F.round("rate", 6))


def success_rate_running(spark: SparkSession, root: str) -> DataFrame:
    rows = metrics.running_rate(table(spark, root, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") != "error")
    return rows.select("event_id", F.round("rate", 6).alias("rate"))


def interval_metric_mean(spark: SparkSession, root: str) -> DataFrame:
    return metrics.interval_mean(_signal(spark, root), ["user_id"], "frame", "value", 10).withColumn("mean", F.round("mean", 6))


def ema_fold(spark: SparkSession, root: str) -> DataFrame:
    return metrics.exponential_mean(_signal(spark, root), ["user_id"], ["frame"], "value", 0.9).withColumn("ema", F.round("ema", 5))


def interarrival_hz(spark: SparkSession, root: str) -> DataFrame:
    rows = metrics.arrival_rate(table(spark, root, "events"), ["user_id"], F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return rows.withColumn("hertz", F.round("hertz", 9))


def interarrival_hz_last(spark: SparkSession, root: str) -> DataFrame:
    rows = metrics.arrival_rate(table(spark, root, "events"), ["user_id"], F.unix_micros(F.col("ts").cast("timestamp")) / 1e6, 50)
    return rows.withColumn("hertz", F.round("hertz", 9))


def prev_total_lag(spark: SparkSession, root: str) -> DataFrame:
    return metrics.previous(table(spark, root, "events"), ["user_id"], ["ts", "event_id"], "value", "previous").select("event_id", "previous")


def gradient_norm(spark: SparkSession, root: str) -> DataFrame:
    return metrics.global_norm(table(spark, root, "lineitem"), "l_quantity").select(F.round("norm", 4).alias("norm"))


def chunk_broker_replay(spark: SparkSession, root: str) -> DataFrame:
    rows = _signal(spark, root).withColumn("chunk", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.col("value") + i))
    return brokers.replayed(rows, ["user_id"], "frame", "chunk", 5).select("event_id", "emitted")


def tumbling_counts(spark: SparkSession, root: str) -> DataFrame:
    return _money(windows.tumbling(windows.timed(table(spark, root, "events"), "ts"), "ts", "1 hour", ["event_type"], "value"))


def sliding_counts(spark: SparkSession, root: str) -> DataFrame:
    return _money(windows.sliding(windows.timed(table(spark, root, "events"), "ts"), "ts", "1 hour", "30 minutes", ["event_type"], "value"))


def session_counts(spark: SparkSession, root: str) -> DataFrame:
    return _money(windows.session(windows.timed(table(spark, root, "events"), "ts"), "ts", "2 hours", ["user_id"], "value"))


def _money(df: DataFrame) -> DataFrame:
    return df.withColumn("total", F.round("total", 4))


def latest_value(spark: SparkSession, root: str) -> DataFrame:
    return windows.newest(table(spark, root, "events"), ["user_id"], "ts", "value").select("user_id", "value")


def prompt_template(spark: SparkSession, root: str) -> DataFrame:
    bins = F.slice(A.digitize(F.transform(A.doubles(F.col("embedding")), lambda x: x * 2)), 1, 6)
    return table(spark, root, "embeddings").select("vec_id", X.prompt(F.concat(F.lit("pick up item "), F.col("label").cast("string")), bins).alias("prompt"))


def text_clean(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "grasp_records").select("object_name").distinct()
    return rows.select("object_name", X.clean_prompt(F.col("object_name")).alias("cleaned"), X.clean_label(F.col("object_name")).alias("label"))


def label_split(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "grasp_records").select("grasp_type").distinct().filter("grasp_type like '%:%'")
    return rows.select("grasp_type", F.split_part("grasp_type", F.lit(":"), F.lit(1)).alias("coarse"), X.clean_label(F.split_part("grasp_type", F.lit(":"), F.lit(2))).alias("fine"))


def action_text_extract(spark: SparkSession, root: str) -> DataFrame:
    text = F.when(F.col("event_id") % 5 == 0, F.lit("nothing")).otherwise(F.concat(F.lit("Task; Action: "), F.col("event_type"), F.lit(" "), F.col("user_id").cast("string"), F.lit("| rest")))
    return table(spark, root, "events").select("event_id", X.between_marks(text, "Action: ", "|").alias("action"))


def json_extract(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def gripper_transform(spark: SparkSession, root: str) -> DataFrame:
    """Some dimensions turned round, two of them scaled to the gripper's range."""
    v = F.slice(A.doubles(F.col("embedding")), 1, 14)
    turned = F.transform(v, lambda x, i: F.when(i.isin(1, 2, 8, 9), -x).when(i.isin(6, 13), X.rescale(x, -0.5, 1.5)).otherwise(x))
    return table(spark, root, "embeddings").select("vec_id", F.transform(turned, lambda x: F.round(x, 6)).alias("joints"))


def quat_axis_angle(spark: SparkSession, root: str) -> DataFrame:
    e = A.doubles(F.col("embedding"))
    n = F.sqrt(F.aggregate(F.slice(e, 1, 4), F.lit(0.0), lambda s, x: s + x * x))
    angle = X.axis_angle(*(e[i] / n for i in range(4)))
    return table(spark, root, "embeddings").select("vec_id", F.transform(angle, lambda x: F.round(x, 5)).alias("rotation"))


def letterbox_geometry(spark: SparkSession, root: str) -> DataFrame:
    box = X.letterbox(F.col("p_size") * 13 + 100, F.col("p_partkey") % 300 + 80, 224, 224)
    rows = table(spark, root, "part").select("p_partkey", box.alias("b")).select("p_partkey", "b.*")
    return rows.select("p_partkey", *(F.col(c).cast("bigint").alias(c) for c in rows.columns[1:]))


def even_scaling(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select("p_partkey", X.even_size(F.col("p_size") + 17, 0.75).alias("size"))


def learning_rate(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select("o_orderkey", F.round(X.warmup_cosine(F.col("o_orderkey"), 1000, 12000, 1.0, 0.1), 8).alias("rate"))


def wide_pivot(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "embeddings").select("vec_id", *(F.col("embedding")[i].cast("double").alias(f"dim_{i}") for i in range(4)))


QUERIES = {
    f.__name__: f
    for f in (
        segment_sessions, segment_split_long, segment_frame_bounds, frame_linspace_sample, frame_round_sample, second_triples, video_chunk_ranges, per_second_shift, resume_antijoin, error_rules, collect_segments,
        range_key_lookup, annotation_progress, active_hands, hand_entries, distinct_tasks, nearest_timestamp, frame_index_round, kb_tiered_topk, confuser_selfjoin, causal_mask_counts, block_mask_counts, fuzzy_label,
        stride_shard, batch_rows, batch_cycle, weighted_mix, shuffle_hash, random_subset, checkpoint_retention, latency_profile, success_rate, success_rate_running, interval_metric_mean, ema_fold, interarrival_hz,
        interarrival_hz_last, prev_total_lag, gradient_norm, chunk_broker_replay, tumbling_counts, sliding_counts, session_counts, latest_value, prompt_template, text_clean, label_split, action_text_extract, json_extract,
        gripper_transform, quat_axis_angle, letterbox_geometry, even_scaling, learning_rate, wide_pivot,
    )
}

_SIGNAL = "signal AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame FROM events)"
_EPS = "eps AS (SELECT DISTINCT * FROM episodes)"
_SESSIONS = """d AS (SELECT DISTINCT base_name, second FROM sequential_seconds), f AS (SELECT *, CASE WHEN second - lag(second) OVER w <= 1 THEN 0 ELSE 1 END AS n FROM d WINDOW w AS (PARTITION BY base_name ORDER BY second)),
    s AS (SELECT *, sum(n) OVER (PARTITION BY base_name ORDER BY second) AS s FROM f), ses AS (SELECT base_name, min(second) AS a, max(second) + 1 AS b, count(*) AS n FROM s GROUP BY base_name, s)"""
_HANDS = "e AS (SELECT unnest(map_keys(analysis.hands)) AS hand, unnest(map_values(analysis.hands)) AS h FROM sequential_seconds WHERE analysis IS NOT NULL)"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def _hash(parts: str) -> str:
    """The stable hash of a list of values."""
    return f"('0x' || substr(md5(concat_ws('|', {parts})), 1, 15))::BIGINT"


ORACLE = {
    "segment_sessions": f'WITH {_SESSIONS} SELECT base_name, a AS start, b AS "end", n FROM ses',
    "segment_split_long": f"""WITH {_SESSIONS} SELECT base_name, a AS start, b AS "end" FROM ses WHERE b - a <= 10
        UNION ALL SELECT base_name, a, (a + b) // 2 FROM ses WHERE b - a > 10 UNION ALL SELECT base_name, (a + b) // 2, b FROM ses WHERE b - a > 10""",
    "segment_frame_bounds": f"WITH {_SESSIONS}, g AS (SELECT base_name, greatest(0, (a - 1) * 30)::BIGINT AS first, least(400, b * 30)::BIGINT AS last FROM ses) SELECT * FROM g WHERE first < last",
    "frame_linspace_sample": f"WITH {_EPS} SELECT episode_index, list_transform(range(15), lambda i: trunc(i * (length - 1) / 14.0::DOUBLE)::BIGINT) AS frames FROM eps",
    "frame_round_sample": f"WITH {_EPS} SELECT episode_index, list_transform(range(9), lambda i: round_even(i * (length - 1) / 8.0::DOUBLE, 0)::BIGINT) AS frames FROM eps",
    "second_triples": f"WITH {_EPS}, s AS (SELECT episode_index, unnest(range((length - 1) // 30)) AS second FROM eps WHERE length > 30) SELECT episode_index, second, [30 * second, 30 * second + 15, 30 * second + 30] AS frame_indices FROM s",
    "video_chunk_ranges": f"""WITH {_EPS}, c AS (SELECT episode_index, length, unnest(range((length + 63) // 64)) AS chunk FROM eps)
        SELECT episode_index, chunk, chunk * 64 AS start, least(chunk * 64 + 64, length) AS "end", round(chunk * 64 / 20.0::DOUBLE, 6) AS at FROM c""",
    "per_second_shift": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY base_name, start_second ORDER BY line_id, batch_id) AS n FROM annotation_lines WHERE base_name IS NOT NULL AND start_second IS NOT NULL AND task_description IS NOT NULL),
        w AS (SELECT base_name, start_second, string_split(task_description, ' ') AS notes FROM r WHERE n = 1)
        SELECT base_name, (start_second + generate_subscripts(notes, 1) - 1)::BIGINT AS second, unnest(notes) AS note FROM w""",
    "resume_antijoin": """SELECT DISTINCT base_name, start_second FROM annotation_lines a WHERE error IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM annotation_lines b WHERE b.error IS NULL AND a.base_name = b.base_name AND a.start_second = b.start_second)""",
    "error_rules": "SELECT count(*) FILTER (WHERE error IS NULL) AS no_error, count(*) FILTER (WHERE coalesce(error, '') = '') AS no_text, count(*) AS lines FROM annotation_lines",
    "collect_segments": "SELECT base_name, list(line_id ORDER BY start_second, line_id) AS lines FROM annotation_lines WHERE base_name IS NOT NULL AND start_second IS NOT NULL AND error IS NULL GROUP BY base_name",
    "range_key_lookup": """WITH r AS (SELECT o_orderkey AS line, o_orderpriority AS info, (o_orderkey * 37) % 500 AS a, (((o_orderkey * 37 + o_custkey % 11 - 5) % 500) + 500) % 500 AS b FROM orders WHERE o_orderkey % 7 <> 0),
        x AS (SELECT line, info, unnest(range(least(a, b), greatest(a, b) + 1)) AS number FROM r) SELECT number, arg_max(info, line) AS info FROM x GROUP BY number""",
    "annotation_progress": """WITH c AS (SELECT base_name, count(*) FILTER (WHERE error IS NULL) AS n, count(*) AS target FROM annotation_lines GROUP BY 1)
        SELECT count(*) FILTER (WHERE n = target) AS complete, count(*) FILTER (WHERE n > 0) AS begun, sum(n)::BIGINT AS pieces FROM c""",
    "active_hands": """WITH h AS (SELECT list_sort(list_distinct(list_transform(coalesce(analysis.active_hands, []), lambda x: lower(x)))) AS h FROM sequential_seconds)
        SELECT CASE WHEN len(h) > 0 THEN array_to_string(h, '+') ELSE 'right' END AS hands, count(*) AS seconds FROM h GROUP BY 1""",
    "hand_entries": f"WITH {_HANDS} SELECT lower(hand) AS hand, h.grasp_type AS grasp_type, count(*) AS entries, count(*) FILTER (WHERE h.object_shape IS NULL) AS shapeless FROM e GROUP BY 1, 2",
    "distinct_tasks": f"WITH {_EPS}, t AS (SELECT source, unnest(tasks) AS task FROM eps) SELECT source, list_sort(list(DISTINCT task)) AS tasks FROM t GROUP BY source",
    "nearest_timestamp": """WITH q AS (SELECT event_id AS query_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'error'), d AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type <> 'error')
        SELECT query_id, arg_min(event_id, (abs(q.t - d.t), d.t, event_id)) AS event_id, min(abs(q.t - d.t)) > 3600000000 AS late FROM q JOIN d USING (user_id) GROUP BY query_id""",
    "frame_index_round": "SELECT p_partkey, greatest(0, least(round_even(p_retailprice / 16 * 8, 0)::BIGINT, 599)) AS frame FROM part",
    "kb_tiered_topk": f"""WITH {_HANDS}, g AS (SELECT h.* FROM e WHERE h.grasp_type IS NOT NULL),
        k AS (SELECT grasp_type AS name, min(grasp_category) AS c, min(opposition_type) AS o, min(thumb_position) AS t, min(virtual_fingers) AS v FROM g GROUP BY 1),
        q AS (SELECT DISTINCT grasp_category, opposition_type, thumb_position, virtual_fingers, concat_ws('|', grasp_category, opposition_type, thumb_position, virtual_fingers) AS query FROM g),
        p AS (SELECT query, name, coalesce(grasp_category = c, false) AS sc, coalesce(opposition_type = o, false) AS so, coalesce(thumb_position = t, false) AS st, coalesce(virtual_fingers = v, false) AS sv FROM q, k),
        r AS (SELECT query, name, CASE WHEN sc AND so AND st THEN 0 WHEN sc AND so THEN 1 WHEN sc THEN 2 ELSE 3 END AS tier, sc::BIGINT + so::BIGINT + st::BIGINT + sv::BIGINT AS score FROM p),
        b AS (SELECT *, min(tier) OVER (PARTITION BY query) AS best FROM r),
        n AS (SELECT query, name, tier::BIGINT AS tier, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, name) AS rank FROM b WHERE tier <= best) SELECT * FROM n WHERE rank <= 3""",
    "confuser_selfjoin": "SELECT source, min(source) OVER w AS \"like\", count(*) OVER w - 1 AS others FROM (SELECT DISTINCT source, robot_type, len(state_low) AS n FROM rigs) WINDOW w AS (PARTITION BY robot_type, n)",
    "causal_mask_counts": f"""WITH {_SIGNAL}, t AS (SELECT user_id, frame, value < 90 AS valid, sum(CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY frame) AS c FROM signal)
        SELECT q.user_id, q.frame, count(*) FILTER (WHERE q.valid AND k.valid AND k.c <= q.c) AS attended FROM t q JOIN t k USING (user_id) GROUP BY q.user_id, q.frame""",
    "block_mask_counts": "WITH p AS (SELECT p_partkey, p_size, unnest(range(p_size)) AS q FROM part WHERE p_size > 0), k AS (SELECT *, unnest(range(p_size)) AS k FROM p) SELECT p_partkey, count(*) FILTER (WHERE q // 3 >= k // 2) AS pairs FROM k GROUP BY 1",
    "stride_shard": "WITH n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS n FROM events) SELECT event_id FROM n WHERE n % 8 = 3",
    "batch_rows": "WITH n AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 64 AS batch FROM orders) SELECT batch, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM n GROUP BY batch HAVING count(*) = 64",
    "batch_cycle": """WITH n AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS n, count(*) OVER () // 16 AS f FROM supplier), b AS (SELECT s_suppkey, n // 16 AS b, n % 16 AS slot, f FROM n WHERE n // 16 < f)
        SELECT s_suppkey, unnest(range(b, 40, f)) AS batch, slot FROM b""",
    "weighted_mix": "SELECT * FROM (VALUES ('click', 4500::BIGINT), ('error', 2700), ('purchase', 1800)) t(event_type, rows)",
    "shuffle_hash": f"SELECT event_id, row_number() OVER (ORDER BY {_hash('11, event_id')}, event_id) - 1 AS place FROM events",
    "random_subset": f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY {_hash('5, l_orderkey, l_linenumber, l_partkey')}, l_orderkey, l_linenumber, l_partkey LIMIT 1000",
    "checkpoint_retention": "SELECT o_orderkey AS step FROM orders WHERE o_orderkey % 1000 = 0 OR o_orderkey = (SELECT max(o_orderkey) FROM orders)",
    "latency_profile": "SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, " + ", ".join(f"round(quantile_cont(value, {q}), 6) AS p{round(q * 100):02d}" for q in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)) + " FROM events GROUP BY event_type",
    "success_rate": "SELECT user_id, count(*) AS episodes, round(avg((event_type <> 'error')::INT), 6) AS rate FROM events GROUP BY user_id",
    "success_rate_running": "SELECT event_id, round(avg((event_type <> 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 6) AS rate FROM events",
    "interval_metric_mean": f"WITH {_SIGNAL} SELECT user_id, ceil(frame / 10.0)::BIGINT AS interval, round(avg(value), 6) AS mean FROM signal GROUP BY 1, 2",
    "ema_fold": f"WITH {_SIGNAL}, l AS (SELECT user_id, list(value ORDER BY frame) AS l FROM signal GROUP BY 1) SELECT user_id, round(list_reduce(l, lambda a, x: a * 0.9::DOUBLE + x * (1 - 0.9::DOUBLE)), 5) AS ema FROM l",
    "interarrival_hz": "WITH d AS (SELECT user_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts) AS d FROM events) SELECT user_id, round(1 / avg(d), 9) AS hertz FROM d GROUP BY user_id",
    "interarrival_hz_last": """WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS n FROM events), d AS (SELECT user_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY user_id ORDER BY ts) AS d FROM n WHERE n <= 50)
        SELECT user_id, round(1 / avg(d), 9) AS hertz FROM d GROUP BY user_id""",
    "prev_total_lag": "SELECT event_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events",
    "gradient_norm": "SELECT round(sqrt(sum(l_quantity * l_quantity)), 4) AS norm FROM lineitem",
    "chunk_broker_replay": f"WITH {_SIGNAL} SELECT s.event_id, a.value + s.frame % 5 AS emitted FROM signal s JOIN signal a ON a.user_id = s.user_id AND a.frame = s.frame - s.frame % 5",
    "tumbling_counts": "SELECT epoch_us(time_bucket(INTERVAL 1 hour, ts)) AS start_us, epoch_us(time_bucket(INTERVAL 1 hour, ts)) + 3600000000 AS end_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
    "sliding_counts": """WITH w AS (SELECT *, unnest([epoch_us(ts) // 1800000000 * 1800000000, epoch_us(ts) // 1800000000 * 1800000000 - 1800000000]) AS start_us FROM events)
        SELECT start_us, start_us + 3600000000 AS end_us, event_type, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY start_us, event_type""",
    "session_counts": """WITH f AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) < 7200000000 THEN 0 ELSE 1 END AS n FROM events),
        s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM f) SELECT epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 7200000000 AS end_us, user_id, count(*) AS n, round(sum(value), 4) AS total FROM s GROUP BY user_id, s""",
    "latest_value": "SELECT user_id, arg_max(value, ts) AS value FROM events GROUP BY user_id",
    "prompt_template": """WITH b AS (SELECT vec_id, label, list_transform(embedding[1:6], lambda x: CASE WHEN x::DOUBLE * 2 < -1 THEN -1 ELSE least(floor((x::DOUBLE * 2 + 1) * 128), 255) END::BIGINT) AS b FROM embeddings)
        SELECT vec_id, 'Task: pick up item ' || label || ', State: ' || array_to_string(b, ' ') || ';' || chr(10) || 'Action: ' AS prompt FROM b""",
    "text_clean": f"SELECT DISTINCT object_name, regexp_replace({_STRIP.format('object_name')}, '[_' || chr(10) || ']', ' ', 'g') AS cleaned, replace({_STRIP.format('lower(object_name)')}, '_', ' ') AS label FROM grasp_records",
    "label_split": f"SELECT DISTINCT grasp_type, split_part(grasp_type, ':', 1) AS coarse, replace({_STRIP.format(chr(108) + 'ower(split_part(grasp_type, chr(58), 2))')}, '_', ' ') AS fine FROM grasp_records WHERE grasp_type LIKE '%:%'",
    "action_text_extract": "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN event_type || ' ' || user_id END AS action FROM events",
    "json_extract": "SELECT event_id, (props::JSON ->> '$.k')::BIGINT AS k FROM events",
    "gripper_transform": "SELECT vec_id, list_transform(embedding[1:14], lambda x, i: round(CASE WHEN i IN (2, 3, 9, 10) THEN -x::DOUBLE WHEN i IN (7, 14) THEN (x::DOUBLE + 0.5) / 2 ELSE x::DOUBLE END, 6)) AS joints FROM embeddings",
    "quat_axis_angle": """WITH q AS (SELECT vec_id, list_transform(embedding[1:4], lambda x: x::DOUBLE) AS e FROM embeddings), n AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(e[1] ** 2 + e[2] ** 2 + e[3] ** 2 + e[4] ** 2)) AS u FROM q),
        d AS (SELECT vec_id, u, greatest(-1.0, least(1.0, u[4])) AS c FROM n)
        SELECT vec_id, list_transform(u[1:3], lambda x: round(x * CASE WHEN sqrt(1 - c * c) <= 1e-8 THEN 0.0 ELSE 2 * acos(c) / sqrt(1 - c * c) END, 5)) AS rotation FROM d""",
    "letterbox_geometry": """WITH s AS (SELECT p_partkey, p_size * 13 + 100 AS w, p_partkey % 300 + 80 AS h FROM part), r AS (SELECT *, greatest(w / 224.0::DOUBLE, h / 224.0::DOUBLE) AS r FROM s),
        k AS (SELECT p_partkey, trunc(w / r)::BIGINT AS width, trunc(h / r)::BIGINT AS height FROM r)
        SELECT p_partkey, width, height, (224 - width) // 2 AS "left", 224 - width - (224 - width) // 2 AS "right", (224 - height) // 2 AS top, 224 - height - (224 - height) // 2 AS bottom FROM k""",
    "even_scaling": "SELECT p_partkey, (ceil((p_size + 17) * 0.75::DOUBLE / 2) * 2)::BIGINT AS size FROM part",
    "learning_rate": """SELECT o_orderkey, round(CASE WHEN o_orderkey < 1000 THEN (o_orderkey + 1) / 1001.0::DOUBLE ELSE 0.1::DOUBLE + 0.9::DOUBLE * 0.5 * (1 + cos(pi() * greatest(0.0, least(1.0, (o_orderkey - 1000) / 11000.0::DOUBLE)))) END, 8) AS rate FROM orders""",
    "wide_pivot": "SELECT vec_id, embedding[1]::DOUBLE AS dim_0, embedding[2]::DOUBLE AS dim_1, embedding[3]::DOUBLE AS dim_2, embedding[4]::DOUBLE AS dim_3 FROM embeddings",
}
