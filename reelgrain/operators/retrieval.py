"""Look-ups that are not by equality: nearest in time, tiers of a knowledge base, masks, fuzzy names."""

from __future__ import annotations

import difflib
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgrain.operators.chunks import last_in, ranged, total_in

def nearest(queries: DataFrame, data: DataFrame, keys: Sequence[str], at: str, time: str, value: str, tolerance: float) -> DataFrame:
    """For each query the data row of its key nearest in time, the earlier of two; ``late`` beyond the tolerance.

    Queries and data are merged in time order, and the last row before and the first from each query on are
    carried along: n log n in place of all pairs.
    """
    q = queries.select(*keys, F.col(at).cast("double").alias("_t"), F.lit(1).alias("_q"), F.struct(*queries.columns).alias("_row"), F.lit(None).cast(data.schema[value].dataType).alias("_v"))
    d = data.select(*keys, F.col(time).cast("double").alias("_t"), F.lit(0).alias("_q"), F.lit(None).cast(q.schema["_row"].dataType).alias("_row"), F.col(value).alias("_v"))
    rows = q.unionByName(d.groupBy(*keys, "_t", "_q", "_row").agg(F.min("_v").alias("_v")))
    here = F.when(F.col("_q") == 0, F.struct("_t", "_v"))
    rows = ranged(rows, keys, ["_t", "_q"])
    rows = last_in(rows, keys, ["_t", "_q"], here, "_a")
    rows = last_in(rows, keys, ["_t", "_q"], here, "_b", backward=True)
    left, right = F.col("_t") - F.col("_a._t"), F.col("_b._t") - F.col("_t")
    best = F.when(F.col("_b").isNull() | (left <= right), F.col("_a")).otherwise(F.col("_b"))
    found = rows.filter("_q = 1").withColumn("_n", best).filter("_n is not null")
    return found.select("_row.*", F.col("_n._v").alias(value), (F.abs(F.col("_t") - F.col("_n._t")) > tolerance).alias("late"))


def contains_any(text: Column, listed: Column) -> Column:
    """Whether some entry of a comma list contains the text or is contained in it."""
    parts = F.transform(F.split(F.lower(listed), ","), F.trim)
    return F.exists(parts, lambda p: (p != "") & (F.contains(text, p) | F.contains(p, text)))


def tiered_top(queries: DataFrame, entries: DataFrame, features: Sequence[tuple[str, str]], tiers: Sequence[Sequence[int]], query: str, name: str, pos: str, k: int) -> DataFrame:
    """The ``k`` best entries of the first tier that any entry meets, by query: ``tier``, ``score``, ``rank``.

    ``features``: pairs of a query's and an entry's column; the score is how many of them are equal
    (null never is). ``tiers``: which features must be equal, from the strictest on; each holds those of
    the last. Queries that meet no tier get the best of all entries, as tier ``len(tiers)``. Ties keep
    the order of ``pos``, which is unique. All joins are by equality: entries that share no feature
    with a query score 0, so that of them the first ones suffice.
    """
    q, e = queries.select(query, *(a for a, _ in features)), entries.select(name, pos, *(b for _, b in features))
    same = [F.coalesce(F.col(a) == F.col(b), F.lit(False)) for a, b in features]
    score = sum((s.cast("bigint") for s in same), F.lit(0).cast("bigint"))
    met = F.lit(None).cast("int")
    for number, tier in reversed(list(enumerate(tiers))):
        met = F.when(reduce(lambda x, y: x & y, (same[i] for i in tier)), F.lit(number)).otherwise(met)
    loosest = reduce(lambda x, y: x & y, (F.col(features[i][0]) == F.col(features[i][1]) for i in tiers[-1]))
    tiered = q.join(e, loosest).select(query, name, pos, met.alias("tier"), score.alias("score")).filter("tier is not null")
    rest = q.join(tiered.select(query).distinct(), query, "left_anti")
    # Entries that share some feature, by an inverted index; then the first of all entries, of which fewer than k can be among those.
    have, held = (F.explode(F.array(*(F.struct(F.lit(i).alias("_i"), F.col(c).cast("string").alias("_v")) for i, c in enumerate(names)))) for names in zip(*features))
    index = e.select(name, pos, held.alias("_f")).select(name, pos, "_f.*").filter("_v is not null")
    shared = rest.select(query, have.alias("_f")).select(query, "_f.*").join(index, ["_i", "_v"]).groupBy(query, name, pos).agg(F.count("*").alias("score"))
    firsts = e.select(F.struct(pos, name).alias("_e")).orderBy("_e").limit(2 * k).agg(F.array_sort(F.collect_list("_e")).alias("_firsts")).withColumn("_one", F.lit(1))
    filler = rest.select(query, F.lit(1).alias("_one")).join(F.broadcast(firsts), "_one").select(query, F.explode("_firsts").alias("_e")).select(query, f"_e.{name}", f"_e.{pos}", F.lit(0).cast("bigint").alias("score"))
    others = shared.unionByName(filler).groupBy(query, name, pos).agg(F.max("score").alias("score")).withColumn("tier", F.lit(len(tiers)))
    top = tiered.unionByName(others).withColumn("_best", F.min("tier").over(Window.partitionBy(query))).filter("tier = _best")
    rank = F.row_number().over(Window.partitionBy(query).orderBy(F.desc("score"), pos))
    return top.withColumn("rank", rank).filter(F.col("rank") <= k).select(query, name, "tier", "score", "rank")


def same_signature(entries: DataFrame, name: str, signature: Sequence[str]) -> DataFrame:
    """The class of each entry: ``name``, ``like`` (the first name of its signature) and ``others``, how many share it.

    Entries of one signature may be taken for one another; members of a class are found by ``like``,
    so no pairs are listed. Null is a value like others; repeated names count once.
    """
    rows = entries.select(name, *signature).distinct()
    classes = rows.groupBy(*signature).agg(F.min(name).alias("like"), (F.count("*") - 1).alias("others")).select(*(F.col(s).alias(f"_{s}") for s in signature), "like", "others")
    return rows.join(classes, reduce(lambda x, y: x & y, (F.col(s).eqNullSafe(F.col(f"_{s}")) for s in signature))).select(name, "like", "others")


def attended(tokens: DataFrame, key: str, pos: str, causal: str, valid: str) -> DataFrame:
    """How many keys each query may attend: those whose running sum of ``causal`` is not larger, both valid.

    The pairs of a sequence are counted, not listed: running sums over distinct sums.
    """
    rows = total_in(ranged(tokens, [key], [pos]), [key], [pos], causal, "_c").withColumn("_c", F.col("_c") + F.coalesce(F.col(causal), F.lit(0))).drop("_p")
    # How many valid keys there are up to each sum: one row per key and sum.
    counts = rows.groupBy(key, "_c").agg(F.sum(F.col(valid).cast("bigint")).alias("_n"))
    seen = total_in(ranged(counts, [key], ["_c"]), [key], ["_c"], "_n", "_seen").select(F.col(key).alias("_key"), F.col("_c").alias("_sum"), (F.col("_seen") + F.coalesce("_n", F.lit(0))).alias("_seen"))
    found = rows.join(seen, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_c") == F.col("_sum")))
    return found.select(key, pos, F.when(F.col(valid), F.col("_seen")).otherwise(F.lit(0)).cast("bigint").alias("attended"))


def block_pairs(length: Column, query_block: int, key_block: int) -> Column:
    """How many (query, key) pairs a block-causal mask keeps in a sequence."""
    kept = lambda q: F.least(length, (F.floor(q / key_block) * query_block + query_block))
    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), length - 1), F.lit(0).cast("bigint"), lambda s, q: s + kept(q))


def closest_name(texts: DataFrame, column: str, allowed: Sequence[str], cutoff: float = 0.6) -> DataFrame:
    """The most similar allowed name by matching blocks, or null below the cutoff.

    No built-in function measures matching blocks. Names that equal their text, and texts too long or
    too short for any name to reach the cutoff, are settled by expressions; the other distinct texts
    are compared in Arrow batches.
    """
    names = list(allowed)

    @F.pandas_udf("string")
    def match(column: pd.Series) -> pd.Series:
        return column.map(lambda t: next(iter(difflib.get_close_matches(t, names, 1, cutoff)), None) if t is not None else None)

    text = F.col(column)
    # Matching blocks are at most the shorter of both: 2 * shorter / (sum of lengths) is the most they can reach.
    reach = reduce(lambda a, b: a | b, (2.0 * F.least(F.length(text), F.lit(len(n))) >= cutoff * (F.length(text) + len(n)) for n in names), F.lit(False))
    rows = texts.select(column).distinct()
    exact = rows.filter(text.isin(*names)).withColumn("closest", text)
    far = rows.filter(text.isNull() | (~text.isin(*names) & ~reach)).withColumn("closest", F.lit(None).cast("string"))
    near = rows.filter(~text.isin(*names) & reach).withColumn("closest", match(column))
    return exact.unionByName(far).unionByName(near)
