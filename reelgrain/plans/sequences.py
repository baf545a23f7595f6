"""Chunks, idle ranges, and datasets put together."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgrain.operators import chunks as C
from reelgrain.operators import datasets as D
from reelgrain.operators import idle as I
from reelgrain.operators.delivery import clip_key
from reelgrain.sources.tables import table


def _frames(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "frames").dropDuplicates(["index"])


def _signal(spark: SparkSession, root: str) -> DataFrame:
    """Events as frames of their user's recording."""
    return C.numbered_by(table(spark, root, "events").select("event_id", "user_id", "value", "ts"), ["user_id"], ["ts", "event_id"], "frame").drop("ts")


def _episodes(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "episodes").distinct()


def action_chunk_clamped(spark: SparkSession, root: str) -> DataFrame:
    return C.action_chunk(_signal(spark, root), ["user_id"], "frame", "value", 8).select("event_id", "chunk", F.col("real").cast("bigint").alias("real"))


def action_chunk_frames(spark: SparkSession, root: str) -> DataFrame:
    """Chunks of 16 task numbers along each episode."""
    rows = C.action_chunk(_frames(spark, root).select("index", "episode_index", "frame_index"), ["episode_index"], "frame_index", "frame_index", 16)
    return rows.select("index", F.array_max("chunk").alias("last_frame"), F.col("real").cast("bigint").alias("real"))


def delta_query_two_sided(spark: SparkSession, root: str) -> DataFrame:
    return C.delta_query(_signal(spark, root), ["user_id"], "frame", "value", [-2, 0, 3]).select("event_id", "delta", "looked", "is_pad")


def chunk_is_pad(spark: SparkSession, root: str) -> DataFrame:
    looked = C.delta_query(_frames(spark, root).select("index", "episode_index", "frame_index"), ["episode_index"], "frame_index", "frame_index", [0, 5, 10])
    return looked.groupBy("episode_index", "delta").agg(F.sum(F.col("is_pad").cast("bigint")).alias("pads"), F.max("looked").alias("furthest"))


def timestamp_sync_check(spark: SparkSession, root: str) -> DataFrame:
    rows = _frames(spark, root).join(table(spark, root, "rigs").select("source", "fps"), "source")
    bad = C.irregular_steps(rows.select("source", "episode_index", "frame_index", "timestamp", "fps"), ["episode_index"], "frame_index", "timestamp", "fps", 1e-6)
    return bad.groupBy("source").agg(F.count("*").alias("irregular"))


def cumulative_value(spark: SparkSession, root: str) -> DataFrame:
    order = ["ts", "event_id"]
    rows = C.total_in(C.ranged(table(spark, root, "events").select("event_id", "user_id", "value", "ts"), ["user_id"], order), ["user_id"], order, "value", "before")
    return rows.select("event_id", F.round(F.col("before") + F.col("value"), 4).alias("total"))


def episode_data_index(spark: SparkSession, root: str) -> DataFrame:
    return C.data_index(_episodes(spark, root))


def global_reindex(spark: SparkSession, root: str) -> DataFrame:
    rows = D.reindexed(_frames(spark, root).select("index", "episode_index", "frame_index").withColumn("was", F.col("index")), C.data_index(_episodes(spark, root)))
    return rows.select("was", "index")


def dataset_locate(spark: SparkSession, root: str) -> DataFrame:
    lengths = table(spark, root, "frames").groupBy(F.col("source").alias("dataset")).agg(F.count("*").alias("rows"))
    positions = table(spark, root, "events").select((F.col("event_id") * 7).alias("position"))
    return C.locate(positions, lengths)


def idle_flags(spark: SparkSession, root: str) -> DataFrame:
    flags = I.idle_flags(_frames(spark, root), ["episode_index"], "frame_index", "action")
    return flags.groupBy("episode_index").agg(F.count_if("idle").alias("idle"), F.count("*").alias("frames"))


def _ranges(spark: SparkSession, root: str) -> DataFrame:
    return I.keep_ranges(I.idle_flags(_frames(spark, root), ["episode_index"], "frame_index", "action", 0.02), ["episode_index"], "frame_index")


def keep_ranges(spark: SparkSession, root: str) -> DataFrame:
    return _ranges(spark, root)


def frames_in_keep_ranges(spark: SparkSession, root: str) -> DataFrame:
    frames = _frames(spark, root).select("index", "episode_index", "frame_index")
    return I.inside_ranges(frames, _ranges(spark, root), ["episode_index"], "frame_index").select("index")


def task_dictionary(spark: SparkSession, root: str) -> DataFrame:
    named = _episodes(spark, root).select("episode_index", F.posexplode("tasks").alias("pos", "task"))
    return D.dictionary(named, "task", ["episode_index", "pos"])


def task_join(spark: SparkSession, root: str) -> DataFrame:
    return D.joined_task(_frames(spark, root).select("index", "task_index"), table(spark, root, "tasks")).groupBy("task").agg(F.count("*").alias("frames"))


def task_reindex(spark: SparkSession, root: str) -> DataFrame:
    tasks = task_dictionary(spark, root)
    frames = _frames(spark, root).select("index", "episode_index", "task_index")
    return D.retasked(frames, _episodes(spark, root), tasks).select("index", "task_index")


def annotation_update(spark: SparkSession, root: str) -> DataFrame:
    notes = table(spark, root, "annotation_lines").filter("error is null and task_description is not null")
    notes = notes.select(F.regexp_extract(clip_key(F.col("base_name")), r"^episode_(\d+)$", 1).try_cast("bigint").alias("episode_index"), "start_second", "line_id", "task_description")
    return D.updated_tasks(_episodes(spark, root).select("episode_index", "tasks"), notes, "episode_index", ["start_second", "line_id"], "task_description")


def annotation_append_offset(spark: SparkSession, root: str) -> DataFrame:
    more = table(spark, root, "grasp_records").filter("object_name is not null").select(F.col("object_name").alias("task")).distinct()
    return D.appended(table(spark, root, "tasks").select("task_index", "task"), more.withColumn("task_index", F.lit(None).cast("bigint")), "task_index", ["task"])


def merge_common_columns(spark: SparkSession, root: str) -> DataFrame:
    short = lambda name, prefix: D.renamed(df := table(spark, root, name), {c: c.removeprefix(prefix) for c in df.columns})
    rows = D.union_common([D.renamed(short("customer", "c_"), {"custkey": "key"}), D.renamed(short("supplier", "s_"), {"suppkey": "key"})])
    return rows.select("dataset_index", "key", "name", "nationkey", "acctbal")


def merge_conflict_check(spark: SparkSession, root: str) -> DataFrame:
    return D.conflicts(table(spark, root, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"])


def episode_chunks(spark: SparkSession, root: str) -> DataFrame:
    return D.chunk_counts(_frames(spark, root).select("index", "episode_index"), 100)


def tasks_unused(spark: SparkSession, root: str) -> DataFrame:
    """Tasks of the dictionary that no episode names."""
    return table(spark, root, "tasks").select("task").exceptAll(_episodes(spark, root).select(F.explode("tasks").alias("task")).distinct())


def tasks_shared(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "tasks").select("task").intersect(_episodes(spark, root).select(F.explode("tasks").alias("task")))


def already_numbered(spark: SparkSession, root: str) -> DataFrame:
    """Episodes all of whose frames have one task number, so that a rewrite can be skipped."""
    rows = _frames(spark, root).groupBy("episode_index").agg(F.min("task_index").alias("lowest"), F.max("task_index").alias("highest"), F.count_if(F.col("task_index").isNull()).alias("missing"))
    return rows.select("episode_index", F.coalesce((F.col("lowest") == F.col("highest")) & (F.col("missing") == 0), F.lit(False)).alias("same"))


QUERIES = {
    f.__name__: f
    for f in (
        action_chunk_clamped, action_chunk_frames, delta_query_two_sided, chunk_is_pad, timestamp_sync_check, cumulative_value, episode_data_index, global_reindex, dataset_locate, idle_flags, keep_ranges,
        frames_in_keep_ranges, task_dictionary, task_join, task_reindex, annotation_update, annotation_append_offset, merge_common_columns, merge_conflict_check, episode_chunks, tasks_unused, tasks_shared, already_numbered,
    )
}

_SIGNAL = "signal AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS frame FROM events)"
_FRAMES = 'one AS (SELECT index, any_value(episode_index) AS episode_index, any_value(frame_index) AS frame_index, any_value("timestamp") AS t, any_value(source) AS source, any_value(task_index) AS task_index, any_value(action) AS action FROM frames GROUP BY index)'
_EPISODES = "eps AS (SELECT DISTINCT * FROM episodes)"
_INDEX = "idx AS (SELECT episode_index, (sum(length) OVER (ORDER BY episode_index) - length)::BIGINT AS a, (sum(length) OVER (ORDER BY episode_index))::BIGINT AS b FROM eps)"
_DICTIONARY = """named AS (SELECT episode_index, unnest(tasks) AS task, generate_subscripts(tasks, 1) AS pos FROM eps),
    firsts AS (SELECT task, min((episode_index, pos)) AS f FROM named GROUP BY task), dict AS (SELECT row_number() OVER (ORDER BY f) - 1 AS task_index, task FROM firsts)"""


def _idle(epsilon: str) -> str:
    return f"""{_FRAMES}, pairs AS (SELECT *, lag(action) OVER (PARTITION BY episode_index ORDER BY frame_index) AS before FROM one),
    flags AS (SELECT episode_index, frame_index, coalesce(list_bool_and(list_transform(list_zip(action, before), lambda p: coalesce(abs(p[1]::DOUBLE - p[2]::DOUBLE) < {epsilon}, false))), before IS NOT NULL AND action IS NOT NULL) AS idle FROM pairs)"""


_KEEP = f"""{_idle('0.02')}, isl AS (SELECT *, frame_index - row_number() OVER (PARTITION BY episode_index, idle ORDER BY frame_index) AS k FROM flags),
    runs AS (SELECT episode_index, idle, k, min(frame_index) AS a, max(frame_index) + 1 AS b FROM isl GROUP BY ALL),
    marked AS (SELECT *, sum(CASE WHEN idle AND b - a >= 7 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_index ORDER BY a) AS part FROM runs),
    kept AS (SELECT episode_index, part, min(a) AS start, max(b) - 10 AS "end" FROM marked WHERE NOT (idle AND b - a >= 7) GROUP BY ALL HAVING max(b) - min(a) >= 16)"""

ORACLE = {
    "action_chunk_clamped": f"""WITH {_SIGNAL}, c AS (SELECT event_id, list(value) OVER (PARTITION BY user_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS c FROM signal)
        SELECT event_id, list_resize(c, 8, c[-1]) AS chunk, len(c) AS real FROM c""",
    "action_chunk_frames": f"""WITH {_FRAMES}, e AS (SELECT *, max(frame_index) OVER (PARTITION BY episode_index) AS top FROM one)
        SELECT index, least(frame_index + 15, top) AS last_frame, least(16, top - frame_index + 1) AS real FROM e""",
    "delta_query_two_sided": f"""WITH {_SIGNAL}, m AS (SELECT *, max(frame) OVER (PARTITION BY user_id) AS top FROM signal),
        d AS (SELECT *, unnest([-2, 0, 3])::BIGINT AS delta FROM m)
        SELECT d.event_id, d.delta, s.value AS looked, (d.frame + d.delta < 0 OR d.frame + d.delta > d.top) AS is_pad
        FROM d JOIN signal s ON s.user_id = d.user_id AND s.frame = greatest(0, least(d.top, d.frame + d.delta))""",
    "chunk_is_pad": f"""WITH {_FRAMES}, m AS (SELECT episode_index, frame_index, max(frame_index) OVER (PARTITION BY episode_index) AS top FROM one), d AS (SELECT *, unnest([0, 5, 10])::BIGINT AS delta FROM m)
        SELECT episode_index, delta, count(*) FILTER (WHERE frame_index + delta > top) AS pads, max(least(top, frame_index + delta)) AS furthest FROM d GROUP BY ALL""",
    "timestamp_sync_check": f"""WITH {_FRAMES}, s AS (SELECT source, t::DOUBLE - lag(t::DOUBLE) OVER (PARTITION BY episode_index ORDER BY frame_index) AS step FROM one)
        SELECT source, count(*) AS irregular FROM s JOIN rigs USING (source) WHERE abs(step - 1.0::DOUBLE / fps) > 1e-6 GROUP BY source""",
    "cumulative_value": f"WITH {_SIGNAL} SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY frame), 4) AS total FROM signal",
    "episode_data_index": f'WITH {_EPISODES}, {_INDEX} SELECT episode_index, a AS "from", b AS "to" FROM idx',
    "global_reindex": f"WITH {_FRAMES}, {_EPISODES}, {_INDEX} SELECT index AS was, a + frame_index AS index FROM one JOIN idx USING (episode_index)",
    "dataset_locate": """WITH l AS (SELECT source AS dataset, count(*) AS n FROM frames GROUP BY source), r AS (SELECT dataset, sum(n) OVER (ORDER BY dataset) - n AS a, sum(n) OVER (ORDER BY dataset) AS b FROM l)
        SELECT event_id * 7 AS position, dataset, (event_id * 7 - a)::BIGINT AS local FROM events JOIN r ON event_id * 7 >= a AND event_id * 7 < b""",
    "idle_flags": f"WITH {_idle('1e-3')} SELECT episode_index, count(*) FILTER (WHERE idle) AS idle, count(*) AS frames FROM flags GROUP BY episode_index",
    "keep_ranges": f'WITH {_KEEP} SELECT episode_index, start, "end" FROM kept',
    "frames_in_keep_ranges": f'WITH {_KEEP} SELECT index FROM one JOIN kept ON one.episode_index = kept.episode_index AND frame_index >= start AND frame_index < "end"',
    "task_dictionary": f"WITH {_EPISODES}, {_DICTIONARY} SELECT task_index, task FROM dict",
    "task_join": f"WITH {_FRAMES} SELECT task, count(*) AS frames FROM one LEFT JOIN tasks USING (task_index) GROUP BY task",
    "task_reindex": f"""WITH {_FRAMES}, {_EPISODES}, {_DICTIONARY}, w AS (SELECT episode_index, min(tasks[1]) AS task FROM eps GROUP BY 1)
        SELECT index, coalesce(dict.task_index, one.task_index) AS task_index FROM one LEFT JOIN w USING (episode_index) LEFT JOIN dict USING (task)""",
    "annotation_update": rf"""WITH {_EPISODES}, c AS (SELECT lower(trim(regexp_replace(regexp_replace(trim(base_name, ' ' || chr(9) || chr(10)), '^.*[/\\]', ''), '(.)\.[A-Za-z0-9]{{1,5}}$', '\1'))) AS clip, start_second, line_id, task_description FROM annotation_lines
            WHERE error IS NULL AND task_description IS NOT NULL),
        n AS (SELECT try_cast(regexp_extract(clip, '^episode_([0-9]+)$', 1) AS BIGINT) AS episode_index, arg_min(task_description, (coalesce(start_second, -1), line_id)) AS d FROM c GROUP BY 1)
        SELECT episode_index, CASE WHEN d IS NOT NULL THEN [d] ELSE tasks END AS tasks FROM eps LEFT JOIN n USING (episode_index)""",
    "annotation_append_offset": """SELECT task_index, task FROM tasks UNION ALL
        SELECT (SELECT max(task_index) FROM tasks) + row_number() OVER (ORDER BY task) AS task_index, task FROM (SELECT DISTINCT object_name AS task FROM grasp_records WHERE object_name IS NOT NULL)""",
    "merge_common_columns": """SELECT 0::BIGINT AS dataset_index, c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
        UNION ALL SELECT 1, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
    "merge_conflict_check": """SELECT o_custkey, count(DISTINCT o_orderstatus) AS o_orderstatus, count(DISTINCT o_orderpriority) AS o_orderpriority FROM orders GROUP BY 1
        HAVING count(DISTINCT o_orderstatus) > 1 OR count(DISTINCT o_orderpriority) > 1""",
    "episode_chunks": f"WITH {_FRAMES} SELECT episode_index, count(*) AS frames, greatest(ceil(count(*) / 100.0), 1)::BIGINT AS chunks FROM one GROUP BY 1",
    "tasks_unused": f"WITH {_EPISODES} SELECT task FROM tasks EXCEPT SELECT unnest(tasks) FROM eps",
    "tasks_shared": f"WITH {_EPISODES} SELECT task FROM tasks INTERSECT SELECT unnest(tasks) FROM eps",
    "already_numbered": f"WITH {_FRAMES} SELECT episode_index, coalesce(min(task_index) = max(task_index) AND count(*) = count(task_index), false) AS same FROM one GROUP BY 1",
}
