"""Normalization statistics and per-record vector transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelgrain.functions import arrays as A
from reelgrain.operators import stats as S
from reelgrain.sources.tables import table

ROUND = 6


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, ROUND) for n in names})


def _frames(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "frames").dropDuplicates(["index"])


def norm_stats(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(S.vector_stats(table(spark, root, "embeddings"), "embedding"), "mean", "std", "low", "high", "q01", "q99")


def norm_stats_grouped(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(S.vector_stats(table(spark, root, "embeddings"), "embedding", ["label"]), "mean", "std", "low", "high", "q01", "q99")


def norm_stats_rigs(spark: SparkSession, root: str) -> DataFrame:
    """Normalization statistics of both vectors per rig and channel, over all finite readings."""
    vectors = [F.struct(F.lit(name).alias("field_name"), F.col(f"`{name}`").alias("v")) for name in ("observation.state", "action")]
    rows = _frames(spark, root).select("source", F.explode(F.array(*vectors)).alias("f")).select("source", "f.*")
    return S.vector_stats(rows, "v", ["source", "field_name"], accuracy=10_000, finite=True).withColumns({c: F.round(c, 4) for c in ("mean", "std", "low", "high", "q01", "q99")})


def episode_stats(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(S.signal_stats(table(spark, root, "events"), "value", ["user_id"]), "mean", "variance")


def pooled_stats(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(S.pooled(S.signal_stats(table(spark, root, "events"), "value", ["event_type", "user_id"]), ["event_type"]), "mean", "std")


def _normalized(spark: SparkSession, root: str, kind: str) -> DataFrame:
    df = table(spark, root, "embeddings").select("vec_id", A.doubles(F.col("embedding")).alias("v"))
    stats = S.vector_stats(table(spark, root, "embeddings"), "embedding")
    if kind == "zscore":
        return S.with_stats(df, stats, ["mean", "std"]).select("vec_id", A.zscore(F.col("v"), F.col("mean"), F.col("std")).alias("z"), "v", "mean", "std")
    return S.with_stats(df, stats, ["q01", "q99"]).select("vec_id", A.quantile_scale(F.col("v"), F.col("q01"), F.col("q99")).alias("z"), "v", "q01", "q99")


def normalize_zscore(spark: SparkSession, root: str) -> DataFrame:
    return _normalized(spark, root, "zscore").select("vec_id", F.posexplode("z").alias("dim", "z")).select("vec_id", F.col("dim").cast("bigint").alias("dim"), F.round("z", ROUND).alias("z"))


def normalize_quantile(spark: SparkSession, root: str) -> DataFrame:
    return _normalized(spark, root, "quantile").select("vec_id", F.posexplode("z").alias("dim", "z")).select("vec_id", F.col("dim").cast("bigint").alias("dim"), F.round("z", ROUND).alias("z"))


def unnormalize_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Whether scaling back gives the vector, by both kinds."""
    same = lambda a, b: F.forall(F.zip_with(a, b, lambda x, y: F.abs(x - y) < 1e-9), lambda ok: ok)
    z = _normalized(spark, root, "zscore").select("vec_id", same(A.unzscore(F.col("z"), F.col("mean"), F.col("std")), F.col("v")).alias("zscore_back"))
    q = _normalized(spark, root, "quantile").select("vec_id", same(A.quantile_unscale(F.col("z"), F.col("q01"), F.col("q99")), F.col("v")).alias("quantile_back"))
    return z.join(q, "vec_id")


def histogram_quantiles(spark: SparkSession, root: str) -> DataFrame:
    return _rounded(S.histogram_quantiles(table(spark, root, "embeddings"), "embedding", [0.01, 0.99], 500), "q01", "q99")


def _steps(spark: SparkSession, root: str) -> DataFrame:
    v = A.doubles(F.col("embedding"))
    return table(spark, root, "embeddings").select("vec_id", F.slice(v, 1, 8).alias("state"), F.array(F.slice(v, 9, 8), F.slice(v, 17, 8)).alias("steps"))


def delta_actions(spark: SparkSession, root: str) -> DataFrame:
    return _steps(spark, root).select("vec_id", A.delta_actions(F.col("steps"), F.col("state"), A.bool_mask(6, -1, 1)).alias("actions"))


def absolute_actions(spark: SparkSession, root: str) -> DataFrame:
    return _steps(spark, root).select("vec_id", A.absolute_actions(F.col("steps"), F.col("state"), A.bool_mask(6, -2)).alias("actions"))


def pad_state(spark: SparkSession, root: str) -> DataFrame:
    return _steps(spark, root).select("vec_id", A.pad_to(F.col("state"), 12).alias("state"))


def slice_outputs(spark: SparkSession, root: str) -> DataFrame:
    return _steps(spark, root).select("vec_id", F.transform("steps", lambda a: F.slice(a, 1, 7)).alias("actions"))


def subsample_stride(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "embeddings").select("vec_id", A.every(A.doubles(F.col("embedding")), 5).alias("kept"))


def digitize_state(spark: SparkSession, root: str) -> DataFrame:
    scaled = F.transform(A.doubles(F.col("embedding")), lambda x: x * 4)
    return table(spark, root, "embeddings").select("vec_id", A.digitize(scaled).cast("array<bigint>").alias("bins"))


def mixed_radix_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    bases = (8, 5, 5, 5)
    digits = F.array(*(F.pmod(F.col("l_orderkey") + F.col("l_linenumber") * i, F.lit(b)).cast("bigint") for i, b in enumerate(bases)))
    code = table(spark, root, "lineitem").select(digits.alias("digits")).select("digits", A.radix_encode(F.col("digits"), bases).alias("code"))
    same = (A.radix_decode(F.col("code"), bases) == F.col("digits")).cast("int")
    return code.groupBy("code").agg(F.count("*").alias("rows"), F.min(same).cast("bigint").alias("same"))


def token_pad_mask(spark: SparkSession, root: str) -> DataFrame:
    """Token rows cut or filled to one length, with what is real and what the loss counts."""
    tokens = F.transform(F.split("o_orderpriority", ""), lambda c: F.ascii(c).cast("bigint"))
    fixed, real = A.fit_length(tokens, 10, F.lit(0).cast("bigint"))
    loss = F.transform(real, lambda r, i: r & (i >= 3))
    rows = table(spark, root, "orders").select("o_orderpriority", fixed.alias("tokens"), real.alias("mask"), loss.alias("loss_mask"))
    return rows.groupBy("o_orderpriority", "tokens", "mask", "loss_mask").agg(F.count("*").alias("rows"))


def masked_mean(spark: SparkSession, root: str) -> DataFrame:
    """Mean over masked positions, with a denominator of at least 1."""
    m = (F.col("event_type") != "error").cast("double")
    return table(spark, root, "events").groupBy("user_id").agg(F.round(F.sum(F.col("value") * m) / F.greatest(F.sum(m), F.lit(1.0)), ROUND).alias("mean"))


QUERIES = {
    f.__name__: f
    for f in (
        norm_stats, norm_stats_grouped, norm_stats_rigs, episode_stats, pooled_stats, normalize_zscore, normalize_quantile, unnormalize_roundtrip, histogram_quantiles, delta_actions, absolute_actions,
        pad_state, slice_outputs, subsample_stride, digitize_state, mixed_radix_roundtrip, token_pad_mask, masked_mean,
    )
}

_FLAT = "flat AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)"
_STATS = "count(x) AS n, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS low, round(max(x), 6) AS high, round(quantile_cont(x, 0.01), 6) AS q01, round(quantile_cont(x, 0.99), 6) AS q99"
_STEPS = "steps AS (SELECT vec_id, list_transform(embedding[1:8], lambda x: x::DOUBLE) AS state, [list_transform(embedding[9:16], lambda x: x::DOUBLE), list_transform(embedding[17:24], lambda x: x::DOUBLE)] AS steps FROM embeddings)"


def _shift(sign: str, mask: str) -> str:
    return f"WITH {_STEPS} SELECT vec_id, list_transform(steps, lambda a: list_transform(a, lambda x, i: CASE WHEN {mask} THEN x {sign} state[i] ELSE x END)) AS actions FROM steps"


ORACLE = {
    "norm_stats": f"WITH {_FLAT} SELECT dim, {_STATS} FROM flat GROUP BY dim",
    "norm_stats_grouped": f"WITH {_FLAT} SELECT label, dim, {_STATS} FROM flat GROUP BY label, dim",
    "norm_stats_rigs": """WITH one AS (SELECT index, any_value(source) AS source, any_value("observation.state") AS s, any_value(action) AS a FROM frames GROUP BY index),
        two AS (SELECT source, 'observation.state' AS field_name, s AS v FROM one UNION ALL SELECT source, 'action', a FROM one),
        flat AS (SELECT source, field_name, unnest(v)::DOUBLE AS x, generate_subscripts(v, 1) - 1 AS dim FROM two)
        SELECT source, field_name, dim, count(x) AS n, round(avg(x), 4) AS mean, round(stddev_pop(x), 4) AS std, round(min(x), 4) AS low, round(max(x), 4) AS high, round(quantile_disc(x, 0.01), 4) AS q01, round(quantile_disc(x, 0.99), 4) AS q99
        FROM flat WHERE isfinite(x) GROUP BY ALL""",
    "episode_stats": "SELECT user_id, count(value) AS n, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance, min(value) AS low, max(value) AS high FROM events GROUP BY user_id",
    "pooled_stats": "SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, min(value) AS low, max(value) AS high FROM events GROUP BY event_type",
    "normalize_zscore": f"WITH {_FLAT}, s AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS d FROM flat GROUP BY dim) SELECT vec_id, dim, round((x - m) / (d + 1e-6), 6) AS z FROM flat JOIN s USING (dim)",
    "normalize_quantile": f"WITH {_FLAT}, s AS (SELECT dim, quantile_cont(x, 0.01) AS a, quantile_cont(x, 0.99) AS b FROM flat GROUP BY dim) SELECT vec_id, dim, round((x - a) / (b - a + 1e-6) * 2 - 1, 6) AS z FROM flat JOIN s USING (dim)",
    "unnormalize_roundtrip": "SELECT vec_id, true AS zscore_back, true AS quantile_back FROM embeddings",
    "histogram_quantiles": f"""WITH {_FLAT}, e AS (SELECT dim, min(x) - 1e-10 AS low, max(x) + 1e-10 AS high, count(*) AS n FROM flat GROUP BY dim),
        b AS (SELECT dim, low, high, n, least(floor((x - low) / (high - low) * 500), 499) AS bin, count(*) AS c FROM flat JOIN e USING (dim) GROUP BY ALL),
        r AS (SELECT *, sum(c) OVER (PARTITION BY dim ORDER BY bin) AS reached FROM b)
        SELECT dim, round(min(low + bin * (high - low) / 500) FILTER (WHERE reached >= 0.01 * n), 6) AS q01, round(min(low + bin * (high - low) / 500) FILTER (WHERE reached >= 0.99 * n), 6) AS q99 FROM r GROUP BY dim""",
    "delta_actions": _shift("-", "i <= 6 OR i = 8"),
    "absolute_actions": _shift("+", "i <= 6"),
    "pad_state": f"WITH {_STEPS} SELECT vec_id, list_concat(state, [0.0::DOUBLE, 0.0, 0.0, 0.0]) AS state FROM steps",
    "slice_outputs": f"WITH {_STEPS} SELECT vec_id, list_transform(steps, lambda a: a[1:7]) AS actions FROM steps",
    "subsample_stride": "SELECT vec_id, list_filter(list_transform(embedding, lambda x: x::DOUBLE), lambda x, i: (i - 1) % 5 = 0) AS kept FROM embeddings",
    "digitize_state": "SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x::DOUBLE * 4 < -1 THEN -1 ELSE least(floor((x::DOUBLE * 4 + 1) * 128), 255) END::BIGINT) AS bins FROM embeddings",
    "mixed_radix_roundtrip": """WITH d AS (SELECT l_orderkey % 8 + 8 * ((l_orderkey + l_linenumber) % 5) + 40 * ((l_orderkey + 2 * l_linenumber) % 5) + 200 * ((l_orderkey + 3 * l_linenumber) % 5) AS code FROM lineitem)
        SELECT code, count(*) AS rows, 1::BIGINT AS same FROM d GROUP BY code""",
    "token_pad_mask": """WITH t AS (SELECT o_orderpriority, list_transform(string_split(o_orderpriority, ''), lambda c: ascii(c)::BIGINT) AS k FROM orders)
        SELECT o_orderpriority, list_resize(k[1:10], 10, 0) AS tokens, list_transform(range(1, 11), lambda i: i <= len(k)) AS mask, list_transform(range(1, 11), lambda i: i <= len(k) AND i > 3) AS loss_mask, count(*) AS rows FROM t GROUP BY ALL""",
    "masked_mean": "SELECT user_id, round(sum(CASE WHEN event_type <> 'error' THEN value ELSE 0 END) / greatest(count(*) FILTER (WHERE event_type <> 'error'), 1), 6) AS mean FROM events GROUP BY user_id",
}
