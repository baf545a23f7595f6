"""Documents packed into containers of fixed token capacity, with a controlled mixture of sources.

Every source is a queue, ordered by length. Containers are filled window by window, by deficit
round-robin: a window gives every source its target share of the tokens as credit; the source with
the most credit opens a container with its longest document, and the sources, by their credit, place
the longest that still fits until none does. What a source could not place, or placed too much, is
carried to the next window.

How many documents of a source have a length is all that this needs to know. So the whole table is
planned at once, over the counts: their number is bounded by sources times capacity, whatever the
number of documents. A window is repeated for as long as there are documents of its lengths. The
documents are then numbered by source and length, with range sorts and no single task, and look up
their container in the plan by that number. The containers depend neither on partitions nor on
groups, and deficits run through all windows of a target.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelgrain.operators.chunks import numbered
from reelgrain.session import materialize

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: How the public byte-level vocabularies cut text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Tokens of a window, in whole containers, at least one.
WINDOW = 32_768
#: Sources with a queue of their own, those of most tokens; all others share one more queue.
QUEUES = 255
#: Target rows that one call takes.
MAX_TARGETS = 1_000
#: Numbers that one row of the plan covers at most, and numbers of a block, by which documents find their row.
REACH, BLOCK = 1 << 20, 64


def token_counts(documents: DataFrame, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``source`` and ``n_tokens`` of every document, over its whole text.

    The vocabulary is read by the driver and travels with the job. Null texts have no tokens; of several rows of one ``doc_id`` the longest counts; rows without
    ``doc_id`` are left out.
    """

    with open(os.path.join(tokenizers, vocabulary), "rb") as f:
        shared = documents.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, shared.value.splitlines())}
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            batch["n_tokens"] = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch["text"]]
            yield batch[["doc_id", "source", "n_tokens"]]

    rows = documents.filter("doc_id is not null").select("doc_id", "source", "text").mapInPandas(count, "doc_id bigint, source string, n_tokens bigint")
    return rows.groupBy("doc_id").agg(F.max_by("source", F.struct("n_tokens", "source")).alias("source"), F.max("n_tokens").alias("n_tokens"))


class Queue:
    """How many documents of each length a source has left; the lengths in use are the bits of one number."""

    def __init__(self) -> None:
        self.left: dict[int, int] = {}
        self.sizes = 0
        self.tokens = 0

    def put(self, size: int, count: int) -> None:
        self.left[size] = self.left.get(size, 0) + count
        self.sizes |= 1 << size
        self.tokens += size * count

    def largest(self, most: int) -> int:
        """The largest size of at most ``most``, or -1."""
        return (self.sizes & ((2 << most) - 1)).bit_length() - 1

    def take(self, size: int, count: int = 1) -> None:
        self.left[size] -= count
        self.tokens -= size * count
        if not self.left[size]:
            del self.left[size]
            self.sizes &= ~(1 << size)


def window_width(capacity: int) -> int:
    """Containers of a window."""
    return max(1, -(-WINDOW // capacity))


def plan_windows(counts: Mapping[tuple[int, int], int], capacity: int, weights: Mapping[int, float] | None = None) -> Iterator[tuple[int, int, dict[tuple[int, int], list[int]]]]:
    """Windows of containers for documents counted by (queue, size), sizes from 1 to ``capacity``.

    Yields the first container of a window, how many times it is repeated (in as many containers
    each), and for each (queue, size) the places of its documents in the window. ``weights`` are the
    queues' target shares; without them the mixture is that of what is left. A queue that has run out
    has no share, and documents of queues without weight fill what the others leave.
    """
    queues: dict[int, Queue] = {}
    for (queue, size), count in sorted(counts.items()):
        queues.setdefault(queue, Queue()).put(size, count)
    credit = dict.fromkeys(queues, 0.0)
    active = sorted(queues)
    width, container = window_width(capacity), 0
    while active:
        worth = {q: float(weights.get(q, 0.0)) if weights is not None else float(queues[q].tokens) for q in active}
        whole = sum(worth.values()) or 1.0
        for q in active:
            credit[q] += worth[q] / whole * width * capacity
        used: dict[tuple[int, int], list[int]] = {}
        for place in range(width):
            room, opened = capacity, False
            while active:
                for q in sorted(active, key=lambda q: (-credit[q], q)):
                    size = queues[q].largest(room)
                    if size > 0:
                        break
                else:
                    break
                queues[q].take(size)
                used.setdefault((q, size), []).append(place)
                credit[q] -= size
                room -= size
                opened = True
                if not queues[q].sizes:
                    active.remove(q)
            if not opened:
                break
        more = min(queues[q].left.get(size, 0) // len(places) for (q, size), places in used.items())
        if more:
            for (q, size), places in used.items():
                queues[q].take(size, more * len(places))
            active = [q for q in active if queues[q].sizes]
        yield container, 1 + more, used
        container += width * (1 + more)


_PLAN = "first bigint, last bigint, origin bigint, uses int, start bigint, width int, places array<int>, wrap bigint"


def _planned(bases: Mapping[int, int], capacities: Sequence[int], weights: Mapping[int, float] | None):
    """The counts of one target -> rows of the plan, in numbers over all targets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        target = int(pdf["target"].iloc[0])
        pdf = pdf.sort_values(["queue", "size"])
        counts = {(int(q), int(s)): int(n) for q, s, n in zip(pdf["queue"], pdf["size"], pdf["n"])}
        starts = dict(zip(counts, bases[target] + np.concatenate([[0], np.cumsum(list(counts.values()))[:-1]])))
        taken, out, containers = dict.fromkeys(counts, 0), [], 0
        width = window_width(capacities[target])

        def emit(first: int, last: int, *rest: object) -> None:
            for a in range(first, last, REACH):
                out.append((a, min(a + REACH, last), first, *rest))

        for container, times, used in plan_windows({c: n for c, n in counts.items() if c[1]}, capacities[target], weights):
            for cell, places in used.items():
                first = int(starts[cell]) + taken[cell]
                taken[cell] += times * len(places)
                emit(first, first + times * len(places), len(places), container, width, places, np.iinfo(np.int64).max)
            containers = container + (times - 1) * width + 1 + max(p for places in used.values() for p in places)
        for cell in (c for c in counts if not c[1]):  # documents without tokens are dealt out over the containers
            emit(int(starts[cell]), int(starts[cell]) + counts[cell], 1, 0, 1, [0], max(1, containers))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _PLAN.split(", ")])

    return run


def packed(documents: DataFrame, targets: DataFrame, *, weights: Mapping[str | None, float] | None = None, tokenizers: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every document in containers of every target.

    ``target_name``, ``capacity``, ``container`` (from 0, by target), ``doc_id``, ``part`` (0 for a
    document that was not split), ``start_token`` and ``n_tokens`` of the piece, ``source``. Only
    documents longer than the capacity are split: into full pieces and one that may be packed with
    others. Documents without tokens are dealt out over the containers.

    ``weights``: target shares of sources (null may be one of them); without them the target is the
    documents' own mixture. A source that runs out before the others has no share from then on, so
    that every document gets its place. Beyond the ``QUEUES`` sources of most tokens the mixture is
    controlled for the others as one.

    Rows without ``doc_id`` are left out, null is a source of its own, targets without a name or a
    positive capacity are left out, and of several targets of one name the largest capacity counts.
    Empty tables give an empty result.
    """
    rows = targets.filter("target_name is not null and capacity_tokens > 0").groupBy("target_name").agg(F.max("capacity_tokens").alias("capacity")).limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets; pack them in several calls")
    wanted = sorted((r[0], int(r[1])) for r in rows)
    capacities = [c for _, c in wanted]
    lengths = materialize(token_counts(documents, tokenizers, vocabulary))
    by_tokens = lengths.groupBy("source").agg(F.sum("n_tokens").alias("t")).orderBy(F.desc("t"), "source").limit(QUEUES).collect()
    numbers = {r["source"]: i for i, r in enumerate(by_tokens)}
    known = lengths.sparkSession.createDataFrame([(s, i) for s, i in numbers.items()], "source string, queue int")
    items = lengths.join(F.broadcast(known), lengths["source"].eqNullSafe(known["source"]), "left").select("doc_id", lengths["source"], "n_tokens", F.coalesce("queue", F.lit(QUEUES)).alias("queue"))
    each = F.array(*(F.struct(F.lit(i).alias("target"), F.lit(c).alias("capacity")) for i, c in enumerate(capacities))) if wanted else F.array().cast("array<struct<target:int,capacity:int>>")
    items = items.withColumn("_t", F.explode(each)).select("*", "_t.*").drop("_t")
    parts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("n_tokens") / F.col("capacity")), F.lit(1)) - 1)
    size = F.least(F.col("n_tokens") - F.col("part") * F.col("capacity"), F.col("capacity")).cast("int")
    pieces = items.withColumn("part", F.explode(parts)).withColumn("size", size).select("target", "queue", "size", "doc_id", "part", "source")
    counts = materialize(pieces.groupBy("target", "queue", "size").agg(F.count("*").alias("n")))
    totals = {r["target"]: r["n"] for r in counts.groupBy("target").agg(F.sum("n").alias("n")).collect()}
    bases = {t: sum(n for u, n in totals.items() if u < t) for t in totals}
    shares = None if weights is None else {numbers.get(s, QUEUES): float(w) for s, w in weights.items()}
    plan = counts.groupBy("target").applyInPandas(_planned(bases, capacities, shares), _PLAN)
    plan = plan.withColumn("block", F.explode(F.sequence(F.expr(f"first div {BLOCK}"), F.expr(f"(last - 1) div {BLOCK}"))))
    placed = numbered(pieces, ["target", "queue", "size", "doc_id", "part"], "number").withColumn("block", F.expr(f"number div {BLOCK}"))
    found = placed.join(plan, "block").filter("number >= first and number < last")
    at = F.col("number") - F.col("origin")
    container = F.col("start") + (F.expr("(number - origin) div uses") * F.col("width") + F.get("places", (at % F.col("uses")).cast("int"))) % F.col("wrap")
    name = F.element_at(F.array(*(F.lit(n) for n, _ in wanted)), F.col("target") + 1) if wanted else F.lit(None).cast("string")
    capacity = F.element_at(F.array(*(F.lit(c) for c in capacities)), F.col("target") + 1) if wanted else F.lit(None).cast("int")
    return found.select(name.alias("target_name"), capacity.alias("capacity"), container.cast("bigint").alias("container"), "doc_id", "part", (F.col("part") * capacity).cast("bigint").alias("start_token"), F.col("size").cast("bigint").alias("n_tokens"), "source")


def fill_report(pieces: DataFrame) -> DataFrame:
    """By target: containers, documents, tokens, the fewest containers that could hold them, the share filled, and the mixture.

    ``mix_distance`` is how far, on average over the tokens, a window's mixture of sources lies from that of all
    documents: half the sum of the differences of their shares, from 0 (the same) to 1 (nothing in common).
    """
    total = pieces.groupBy("target_name", "capacity").agg(F.count_distinct("container").alias("containers"), F.count_distinct("doc_id").alias("documents"), F.sum("n_tokens").alias("tokens"))
    window = F.floor(F.col("container") / F.ceil(F.lit(WINDOW) / F.col("capacity"))).alias("window")
    cells = pieces.groupBy("target_name", window, "source").agg(F.sum("n_tokens").alias("t"))
    wanted = cells.groupBy("target_name", "source").agg(F.sum("t").alias("all_t")).withColumn("whole", F.sum("all_t").over(Window.partitionBy("target_name")))
    shares = wanted.select(F.col("target_name").alias("_n"), F.col("source").alias("_s"), (F.col("all_t") / F.col("whole")).alias("want"))
    sums = cells.groupBy("target_name", "window").agg(F.sum("t").alias("w"))
    beside = cells.join(sums, ["target_name", "window"]).join(shares, (F.col("target_name") == F.col("_n")) & F.col("source").eqNullSafe(F.col("_s")))
    # Sources that a window lacks differ by their whole share.
    off = (F.sum(F.abs(F.col("t") / F.col("w") - F.col("want"))) + 1 - F.sum("want")) / 2
    mixed = beside.groupBy("target_name", "window").agg(off.alias("off"), F.first("w").alias("w")).groupBy("target_name").agg((F.sum(F.col("off") * F.col("w")) / F.sum("w")).alias("mix_distance"))
    least = F.ceil(F.col("tokens") / F.col("capacity")).alias("fewest")
    return total.join(mixed, "target_name", "left").select("target_name", "capacity", "containers", "documents", "tokens", least, (F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("filled"), "mix_distance")


def kept_promises(documents: DataFrame, pieces: DataFrame) -> DataFrame:
    """By target, what must hold of any packing, by counting.

    ``documents``: how many have a place; ``missing``: those without one; ``overfull``: containers beyond
    the capacity; ``split``: documents in more pieces than their length asks for, or whose pieces don't
    add up; ``near_fewest``: whether there are at most 2 in 100 containers (and 8) more than the tokens need.
    """
    held = pieces.groupBy("target_name", "capacity", "container").agg(F.sum("n_tokens").alias("t"))
    full = held.groupBy("target_name", "capacity").agg(F.count_if(F.col("t") > F.col("capacity")).alias("overfull"), F.count("*").alias("_c"), F.sum("t").alias("_t"))
    parts = pieces.groupBy("target_name", "capacity", "doc_id").agg(F.count("*").alias("p"), F.sum("n_tokens").alias("t"), F.max("part").alias("m"))
    wrong = (F.col("p") != F.greatest(F.lit(1), F.ceil(F.col("t") / F.col("capacity")))) | (F.col("m") + 1 != F.col("p"))
    by = parts.groupBy("target_name").agg(F.count("*").alias("documents"), F.count_if(wrong).alias("split"))
    all_ids = documents.select(F.count_distinct("doc_id").alias("_all"))
    near = F.col("_c") <= F.ceil(F.col("_t") / F.col("capacity")) * 1.02 + 8
    rows = full.join(by, "target_name").withColumn("_one", F.lit(1)).join(F.broadcast(all_ids.withColumn("_one", F.lit(1))), "_one")
    return rows.select("target_name", "capacity", "documents", (F.col("_all") - F.col("documents")).alias("missing"), "overfull", "split", near.alias("near_fewest"))
