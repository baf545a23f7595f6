"""Evaluation texts that leak into training text.

The words of all test items form one generalised suffix automaton. Every document is streamed
through it word by word; the automaton's state tells the longest stretch that ends at the word and
occurs in some item. Where such a stretch can't go on, all its places in items are looked up, and each
is extended to both sides over single small edits, which gives the item's span that the document holds.
Spans beyond the limit of length are leaks; they can be cut out of the documents, and documents that
consist of them to a large share be left out. Items are a small fixed set; documents are only read,
nothing of them is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgrain.llm.text_norm import placed_words, words

#: Fixed value: the closing line that many items share; it belongs to none.
CLOSING_LINE = "Answer in one short sentence and name the hand you mean."
#: Item words that one automaton holds (about 1 KB each, in the driver and in every task); more items are gone
#: through in slices, each of which reads the documents once.
SLICE_WORDS = 300_000


class SuffixAutomaton:
    """Generalised suffix automaton over word numbers, with the places where each state ends."""

    def __init__(self, items: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int, int]] = []
        for number, item in enumerate(items):
            last = 0
            for at, word in enumerate(item):
                last = self._extend(last, word)
                ends.append((last, number, at))
        # A state's places are its own and those of all states that it is the suffix of: in the order of a walk
        # through the tree of suffix links these are neighbours, so each place is kept once.
        below: list[list[int]] = [[] for _ in self.length]
        for state, parent in enumerate(self.link[1:], 1):
            below[parent].append(state)
        first, beyond, walk, step = [0] * len(below), [0] * len(below), [(0, False)], 0
        while walk:
            state, done = walk.pop()
            if done:
                beyond[state] = step
                continue
            first[state] = step
            step += 1
            walk.append((state, True))
            walk.extend((child, False) for child in below[state])
        ends.sort(key=lambda e: first[e[0]])
        order = [first[state] for state, _, _ in ends]
        self.places = np.array([(number, at) for _, number, at in ends], np.int32).reshape(-1, 2)
        self.reach = np.array([(bisect_left(order, a), bisect_left(order, b)) for a, b in zip(first, beyond)], np.int32)

    def occurrences(self, state: int) -> list[list[int]]:
        """The items, and the places in them, where the state's stretch ends."""
        a, b = self.reach[state]
        return self.places[a:b].tolist()

    def _add(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, word: int, q: int) -> int:
        """The state of the stretch of length[p] + 1 that ends in ``word``."""
        if self.length[q] == self.length[p] + 1:
            return q
        copy = self._add(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new, p = self._add(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.next[p][word])
        return new

    def stretches(self, text: list[int], shortest: int) -> Iterator[tuple[int, int, int]]:
        """Last word, length and state of every stretch of at least ``shortest`` words that can't go on."""
        follow, link, lengths = self.next, self.link, self.length
        state = matched = 0
        for at, word in enumerate(text):
            after = follow[state].get(word)
            if after is None:
                if matched >= shortest:
                    yield at - 1, matched, state
                while state and (after := follow[state].get(word)) is None:
                    state = link[state]
                    matched = lengths[state]
                if not state:
                    matched = 0
                    after = follow[0].get(word, 0)
                state = after
                matched += after > 0
            else:
                state = after
                matched += 1
        if matched >= shortest:
            yield len(text) - 1, matched, state


def _beyond(text: list[int], i: int, item: list[int], j: int, step: int, between: int) -> tuple[int, int]:
    """How many more of the item's words are held beyond an edit at (i, j), in direction ``step``, and the text's words they take."""
    best = (0, 0)
    for di, dj in ((step, step), (step, 0), (0, step)):
        a, b = i + di, j + dj
        run = 0
        while 0 <= a < len(text) and 0 <= b < len(item) and text[a] == item[b]:
            a, b, run = a + step, b + step, run + 1
        if run:
            more, further = _beyond(text, a, item, b, step, between) if run >= between else (0, 0)
            best = max(best, (abs(dj) + run + more, abs(di) + run + further))
    return best


def held_span(text: list[int], end: int, item: list[int], at: int, between: int = 5) -> tuple[int, int, int]:
    """The longest span of ``item`` around ``item[at] == text[end]`` that the text holds: its words, and where it starts and ends in the text.

    Between two edits (a word changed, added or left out) lie at least ``between`` equal words. A
    single changed or missing word at an end of the item counts as held if such a run lies beside it.
    """
    i, j, k, m = end, at, end, at
    while i >= 0 and j >= 0 and text[i] == item[j]:
        i, j = i - 1, j - 1
    while k < len(text) and m < len(item) and text[k] == item[m]:
        k, m = k + 1, m + 1
    if m - j - 1 >= between:
        (before, back), (after, on) = _beyond(text, i, item, j, -1, between), _beyond(text, k, item, m, 1, between)
        i, j, k, m = i - back, j - before, k + on, m + after
    left, right = (-1 if j == 0 else j), (len(item) if m == len(item) - 1 else m)
    return right - left - 1, i + 1, k


class LeakFinder:
    """The items that a document holds. ``span``: words of an item that make a leak."""

    def __init__(self, items: dict[int, str], span: int = 18, shortest: int = 5) -> None:
        closing = words(CLOSING_LINE)
        self.span, self.shortest = span, shortest
        self.numbers: dict[str, int] = {}
        self.ids, texts = [], []
        for key, text in items.items():
            w = words(text)
            if w[-len(closing) :] == closing:
                w = w[: -len(closing)]
            if w:
                self.ids.append(key)
                texts.append([self.numbers.setdefault(x, len(self.numbers)) for x in w])
        self.texts = texts
        # Two words that a text writes as one, as where a hyphen was left out.
        known = list(self.numbers)
        self.joined = {known[a] + known[b]: (a, b) for t in texts for a, b in zip(t, t[1:])}
        self.needed = [min(span, len(t)) for t in texts]
        # An item shorter than the shortest stretch can only be held as a whole.
        self.shortest = max(1, min([shortest, *self.needed]))
        self.automaton = SuffixAutomaton(texts)

    def spans(self, text_words: list[str]) -> dict[int, tuple[int, list[tuple[int, int]]]]:
        """Item -> words of its longest span that the text holds, and where in the text its spans lie, where it is a leak."""
        get, joined = self.numbers.get, self.joined
        numbers = [get(w, -1) for w in text_words]
        own: Sequence[int] = range(len(numbers))  # the text's word of each number
        if any(n < 0 and w in joined for n, w in zip(numbers, text_words)):
            both = [(n, place) for place, (n, w) in enumerate(zip(numbers, text_words)) for n in (joined.get(w, (-1,)) if n < 0 else (n,))]
            numbers, own = [n for n, _ in both], [place for _, place in both]
        found: dict[int, tuple[int, list[tuple[int, int]]]] = {}
        automaton = self.automaton
        for end, _, state in automaton.stretches(numbers, self.shortest):
            seen = set()
            # Also the places of shorter endings: another item may go on to the left in another way.
            while state > 0 and automaton.length[state] >= self.shortest:
                for item, at in automaton.occurrences(state):
                    if (item, at) not in seen:
                        seen.add((item, at))
                        held, first, beyond = held_span(numbers, end, self.texts[item], at)
                        if held >= self.needed[item]:
                            most, lying = found.get(item, (0, []))
                            found[item] = (max(most, held), [*lying, (own[first], own[beyond - 1] + 1)])
                state = automaton.link[state]
        return {self.ids[item]: held for item, held in found.items()}

    def leaks(self, text: str | None) -> dict[int, int]:
        """Item -> words of its longest span that the text holds, where it is a leak."""
        return {item: held for item, (held, _) in self.spans(words(text)).items()} if text else {}

    def cut(self, text: str | None) -> tuple[str | None, int, int]:
        """The text as read without the leaked spans, the words of it that were cut out, and all its words.

        A text without leaks stays as it is.
        """
        if not text:
            return text, 0, 0
        shown, placed = placed_words(text)
        found = self.spans([w for w, _, _ in placed])
        if not found:
            return text, 0, len(placed)
        out, reached, gone, at = [], 0, 0, 0
        for first, beyond in sorted(p for _, lying in found.values() for p in lying):
            first = max(first, reached)
            if first < beyond:
                out.append(shown[at : placed[first][1]])
                gone, reached, at = gone + beyond - first, beyond, placed[beyond - 1][2]
        return "".join([*out, shown[at:]]), gone, len(placed)


def _finders(documents: DataFrame, items: DataFrame, span: int, shortest: int) -> Iterator:
    """Finders for slices of the items, each sent to all tasks."""
    rows = items.filter("item_id is not null and text is not null").select("item_id", "text").distinct()
    total = rows.select(F.coalesce(F.sum(F.size(F.split("text", r"\s+"))), F.lit(0))).first()[0]
    slices = max(1, -(-total // SLICE_WORDS))
    for i in range(slices):
        texts: dict[int, list[str]] = {}
        for key, text in rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == i).collect():
            texts.setdefault(key, []).append(text)
        yield documents.sparkSession.sparkContext.broadcast(LeakFinder({(k, n): t for k, several in texts.items() for n, t in enumerate(sorted(several))}, span, shortest))


def leaked_items(documents: DataFrame, items: DataFrame, *, span: int = 18, shortest: int = 5) -> DataFrame:
    """``doc_id``, ``item_id`` and ``words`` (the longest span held) of every item that a document holds.

    A document holds an item if it has the whole of it, or at least ``span`` successive words, with
    single words changed, misspelled, added or left out as long as at least ``shortest`` equal words
    lie between two edits. Case, punctuation, spacing, line marks, mark-up and invisible characters
    don't count. Null or empty texts hold nothing; rows of one ``doc_id`` are one document, repeated
    rows come out once; a null ``doc_id`` comes out as null; several texts of one ``item_id`` are all
    looked for. Empty tables give an empty result.
    """

    def search(shared):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = [(d, i, n) for d, t in zip(batch["doc_id"], batch["text"]) for (i, _), n in shared.value.leaks(t).items()]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "words"])

        return run

    rows = documents.select("doc_id", "text").filter("text is not null")
    parts = [rows.mapInPandas(search(shared), "doc_id bigint, item_id bigint, words int") for shared in _finders(documents, items, span, shortest)]
    return reduce(DataFrame.unionByName, parts).groupBy("doc_id", "item_id").agg(F.max("words").alias("words"))


def without_leaks(documents: DataFrame, items: DataFrame, *, span: int = 18, shortest: int = 5, coverage: float = 0.5) -> DataFrame:
    """The documents with leaked spans cut out: ``doc_id``, ``text``, ``cut_words``, ``words``.

    Documents of whose words more than the share ``coverage`` is leaked are left out. Texts without
    leaks stay as they are; of others the text as read (compatibility forms folded, mark-up and
    invisible characters taken out) is kept around the spans. Null and empty texts stay; repeated
    rows stay repeated.
    """

    def clean(shared):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = [shared.value.cut(t) for t in batch["text"]]
                words_before = [n if w < 0 else w for (_, _, n), w in zip(found, batch["words"])]
                yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [f[0] for f in found], "cut_words": batch["cut_words"] + [f[1] for f in found], "words": words_before})

        return run

    rows = documents.select("doc_id", "text", F.lit(0).cast("bigint").alias("cut_words"), F.lit(-1).cast("bigint").alias("words"))
    for shared in _finders(documents, items, span, shortest):
        rows = rows.mapInPandas(clean(shared), "doc_id bigint, text string, cut_words bigint, words bigint")
    return rows.filter(F.col("cut_words") <= F.lit(coverage) * F.col("words"))
