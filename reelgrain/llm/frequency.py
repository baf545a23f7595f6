"""Frequency of every distinct term and of every run of terms, by suffix-sorted counting.

A record's cell is a sequence of terms. For each position one suffix, cut at ``longest`` terms, is
counted; all n-grams are prefixes of these suffixes. Equal suffixes are folded before any shuffle,
then routed by their first term (and a salt of the second, so that one frequent term may hold a third
of all rows), sorted in reverse lexicographic order and read once with a stack that sums up every
prefix when it ends. Instead of record sets, each suffix carries for each prefix length the number
of records in which that prefix had not occurred before: these add up to exact record counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgrain.session import shuffle_partitions

#: Distinct suffixes that a task holds before it hands them on.
FOLD_AT = 200_000


def entries(cell: str | None) -> list[str]:
    """The entries of a cell, parted by ``;``, in lower case, with underscores as spaces and single blanks."""
    if cell is None:
        return []
    return [e for e in (" ".join(part.split()) for part in cell.lower().replace("_", " ").split(";")) if e]


def _suffixes(fields: Sequence[str], longest: int, split: Callable[[str | None], list[str]]):
    """Rows sorted by key -> folded suffixes with occurrences and, by prefix length, new records."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[tuple[str, tuple[str, ...]], list[int]] = {}
        key, seen, before = None, set(), None

        def flush() -> pd.DataFrame:
            out = pd.DataFrame([(f, list(s), c[0], c[1:]) for (f, s), c in counts.items()], columns=["field_name", "suffix", "occurrences", "records"])
            counts.clear()
            return out

        for batch in batches:
            for row in batch.itertuples(index=False, name=None):
                if row[0] != key:
                    key, before = row[0], None
                    seen.clear()
                if row == before:
                    continue
                before = row
                for field, cell in zip(fields, row[1:]):
                    terms = split(cell)
                    for i in range(len(terms)):
                        suffix = tuple(terms[i : i + longest])
                        c = counts.get((field, suffix))
                        if c is None:
                            c = counts[field, suffix] = [0] * (longest + 1)
                        c[0] += 1
                        for n in range(1, len(suffix) + 1):
                            gram = (field, suffix[:n])
                            if gram not in seen:
                                seen.add(gram)
                                c[n] += 1
            if len(counts) > FOLD_AT:
                yield flush()
        if counts:
            yield flush()

    return run


def _stack(longest: int):
    """Suffixes in reverse lexicographic order -> all their prefixes with sums."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field: str | None = None
        open_terms: list[str] = []
        sums: list[list[int]] = []
        out: list[tuple] = []

        def pop(depth: int) -> None:
            while len(open_terms) > depth:
                occurrences, records = sums.pop()
                out.append((field, list(open_terms), occurrences, records))
                open_terms.pop()
                if sums:
                    sums[-1][0] += occurrences

        for batch in batches:
            for name, suffix, occurrences, records in batch.itertuples(index=False, name=None):
                if name != field:
                    pop(0)
                    field = name
                shared = 0
                while shared < min(len(open_terms), len(suffix)) and open_terms[shared] == suffix[shared]:
                    shared += 1
                pop(shared)
                for term in suffix[shared:]:
                    open_terms.append(term)
                    sums.append([0, 0])
                sums[-1][0] += int(occurrences)
                for n in range(len(suffix)):
                    sums[n][1] += int(records[n])
            yield pd.DataFrame(out, columns=["field_name", "ngram", "occurrences", "records"])
            out.clear()
        pop(0)
        yield pd.DataFrame(out, columns=["field_name", "ngram", "occurrences", "records"])

    return run


def term_frequencies(records: DataFrame, fields: Sequence[str], *, key: str = "record_id", longest: int = 1, salts: int = 16, split: Callable[[str | None], list[str]] = entries) -> DataFrame:
    """``field_name``, ``ngram``, ``occurrences`` and ``records`` of all runs of up to ``longest`` terms.

    Exact repeats of a row count once; rows of one key are one record, and their occurrences add up.
    Rows without a key are left out. Null and empty cells hold no terms; an empty table gives an
    empty result; further columns are ignored.
    """
    n = shuffle_partitions(records.sparkSession)
    rows = records.select(F.col(key).alias("_key"), *(F.col(f"`{f}`").cast("string").alias(f"_f{i}") for i, f in enumerate(fields))).filter("_key is not null")
    ordered = rows.repartition(n, "_key").sortWithinPartitions("_key", *(f"_f{i}" for i in range(len(fields))))
    folded = ordered.mapInPandas(_suffixes(list(fields), longest, split), "field_name string, suffix array<string>, occurrences bigint, records array<bigint>")
    total = [F.sum(F.col("records")[i]) for i in range(longest)]
    folded = folded.groupBy("field_name", "suffix").agg(F.sum("occurrences").alias("occurrences"), F.array(*total).alias("records"))
    salt = F.pmod(F.xxhash64(F.get("suffix", F.lit(1))), F.lit(salts))
    routed = folded.repartition(n, "field_name", F.col("suffix")[0], salt).sortWithinPartitions("field_name", F.col("suffix").desc())
    grams = routed.mapInPandas(_stack(longest), "field_name string, ngram array<string>, occurrences bigint, records bigint")
    return grams.groupBy("field_name", "ngram").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def marked_terms(records: DataFrame, fields: Sequence[str], *, key: str = "record_id", longest: int = 3, rare_below: int = 3, common_above: float = 0.1) -> DataFrame:
    """All runs of up to ``longest`` terms with their counts, and a ``mark``: ``rare``, ``common`` or null.

    ``term`` has the terms of a run joined by ``; ``, which no single term holds, and ``length`` their
    number. Rare: in fewer than ``rare_below`` records; common: in more than the share
    ``common_above`` of all records. A run that is both, in a table of very few records, is rare.
    """
    every = records.select(F.count_distinct(F.col(key))).scalar()
    runs = term_frequencies(records, fields, key=key, longest=longest)
    runs = runs.select("field_name", F.array_join("ngram", "; ").alias("term"), F.size("ngram").alias("length"), "occurrences", "records")
    return runs.withColumn("mark", F.when(F.col("records") < rare_below, "rare").when(F.col("records") > common_above * every, "common"))
