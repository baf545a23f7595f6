import random

import pytest

from reelgrain.llm.leakage import LeakFinder, SuffixAutomaton, held_span, leaked_items, without_leaks
from reelgrain.llm import leakage
from reelgrain.llm.text_norm import placed_words, words

ITEM = "In take 789, the pharmacy clerk peels the film off the perforated cello bridge and then threads a waxed cord through a borrowed birdhouse. Next to a crooked roof tile, where three coins lie in a row, an apprentice watchmaker winds twice around the wrist a cracked bee smoker. Answer in one short sentence and name the hand you mean."
W = words(ITEM)[:-11]
SHORT = "Explain what the wrist has to prevent when an apprentice watchmaker drags along a chalk line the half-filled roof tile?"


@pytest.fixture(scope="module")
def finder():
    return LeakFinder({1: ITEM, 2: SHORT, 3: "tiny item here"})


def test_automaton_against_search():
    r = random.Random(1)
    for _ in range(60):
        items = [[r.randrange(3) for _ in range(r.randrange(1, 14))] for _ in range(4)]
        text = [r.randrange(4) for _ in range(40)]
        a = SuffixAutomaton(items)
        inside = lambda s: any(s == x[i : i + len(s)] for x in items for i in range(len(x)))
        longest = [max(n for n in range(e + 2) if not n or inside(text[e + 1 - n : e + 1])) for e in range(40)]
        want = [(e, longest[e]) for e in range(40) if longest[e] and (e == 39 or longest[e + 1] != longest[e] + 1)]
        got = list(a.stretches(text, 1))
        assert [(e, n) for e, n, _ in got] == want
        for e, n, state in got:
            s = text[e + 1 - n : e + 1]
            assert sorted(a.occurrences(state)) == sorted([k, i + n - 1] for k, x in enumerate(items) for i in range(len(x)) if x[i : i + n] == s)


@pytest.mark.parametrize(
    ("text", "leaks"),
    [
        (ITEM, {1}),
        ("before it. " + " ".join(W[4:22]) + " and after", {1}),
        ("before it. " + " ".join(W[4:20]) + " and after", set()),
        (" ".join(W[4:22]).upper(), {1}),
        ("<p>" + " <b>".join(W[4:22]) + "</b></p>", {1}),
        ("\n".join("> " + " ".join(W[i : i + 4]) for i in range(0, 28, 4)), {1}),
        ("\n".join(f"[11:0{i % 10}] op{i}: " + " ".join(W[i : i + 3]) for i in range(0, 27, 3)), {1}),
        ("​".join(" ".join(W[4:24])), {1}),
        (" ".join(W[4:24]), {1}),
        (" ".join([*W[:6], "quite", *W[6:12], "peeels", *W[13:19], *W[20:26]]), {1}),
        (" ".join([*W[:6], "quite", *W[6:9], "peeels", *W[10:13], *W[14:18]]), set()),
        ("Answer in one short sentence and name the hand you mean. " * 3, set()),
        (SHORT.replace("half-filled", "halffilled"), {2}),
        (SHORT.replace("Explain", "Say"), {2}),
        ("a tiny item here", {3}),
        (None, set()),
        ("", set()),
        ("word " * 100_000 + " ".join(W), {1}),
    ],
)
def test_cases(finder, text, leaks):
    assert set(finder.leaks(text)) == leaks


def test_held_span_against_alignment():
    """The longest span by trying every alignment of edits."""
    r = random.Random(7)

    def best(text, item, between):
        top = 0

        def go(i, j, run, start):
            nonlocal top
            while i < len(text) and j < len(item) and text[i] == item[j]:
                i, j, run = i + 1, j + 1, run + 1
                top = max(top, j - start)
            if run >= between:
                for di, dj in ((1, 1), (1, 0), (0, 1)):
                    if i + di < len(text) and j + dj < len(item) and text[i + di] == item[j + dj]:
                        go(i + di, j + dj, 0, start)

        def first(i, j):  # the first run may be short: then one edit after it
            start = j
            n = 0
            while i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n]:
                n += 1
            nonlocal top
            top = max(top, n)
            go(i, j, 0, start)
            if 0 < n < between:
                for di, dj in ((1, 1), (1, 0), (0, 1)):
                    a, b = i + n + di, j + n + dj
                    if a < len(text) and b < len(item) and text[a] == item[b]:
                        go(a, b, 0, start)

        for i in range(len(text)):
            for j in range(len(item)):
                if text[i] == item[j]:
                    first(i, j)
        return top

    for _ in range(150):
        item = list(range(100, 140))
        text, k = [], 0
        while k < 36:
            n = r.choice([2, 4, 5, 6, 8])
            text += item[k : k + n]
            k += n
            edit = r.choice(["change", "add", "drop"])
            text += [1] if edit != "drop" else []
            k += edit != "add"
        spans = [held_span(text, e, item, j, 3)[0] for e, w in enumerate(text) for j, v in enumerate(item) if v == w]
        inner = [s for s in spans if s < 38]
        assert not inner or max(inner) <= 40
        assert max(spans) >= best(text, item, 3)


def test_table(spark):
    docs = spark.createDataFrame([(1, ITEM, 0), (1, ITEM, 0), (2, None, 0), (3, "x " + SHORT, 0), (None, SHORT, 0), (4, "", 0)], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(10, ITEM), (11, SHORT), (12, None), (None, "lost"), (13, ""), (14, ITEM)], "item_id bigint, text string")
    got = sorted((str(r["doc_id"]), r["item_id"]) for r in leaked_items(docs, items).collect())
    assert got == [("1", 10), ("1", 14), ("3", 11), ("None", 11)]
    assert leaked_items(docs.filter("false"), items).count() == 0 and leaked_items(docs, items.filter("false")).count() == 0


def test_shorter_endings_are_looked_up():
    """Where the longest ending leads to one item, a shorter one may lead to another that goes on elsewhere."""
    shared = [f"s{i}" for i in range(6)]
    a = ["x", "y", *shared, "a1", "a2"]
    b = [*(f"b{i}" for i in range(12)), *shared, *(f"c{i}" for i in range(6))]
    finder = LeakFinder({1: " ".join(a), 2: " ".join(b)})
    text = [*b[:11], "x", "y", *shared, "wrong", *b[19:]]  # the sixth shared word ends a longer stretch of item 1
    assert finder.automaton.stretches([finder.numbers.get(w, -1) for w in text], 5)
    assert set(finder.leaks(" ".join([*b[:12], *shared, "wrong", *b[19:]]))) == {2}


def test_spans_are_cut(finder):
    before, after = "A note that stays here. ", " And this stays as well."
    text, gone, total = finder.cut(before + " ".join(W[4:26]) + after)
    assert gone == 22 and total == 22 + 10 and text == before + after
    edited = " ".join([*W[:6], "quite", *W[6:12], "peeels", *W[13:26]])
    text, gone, _ = finder.cut("Start. " + edited + " End.")
    assert gone == 27 and text == "Start.  End."
    assert finder.cut("nothing of that") == ("nothing of that", 0, 3) and finder.cut(None) == (None, 0, 0) and finder.cut("") == ("", 0, 0)
    text, gone, total = finder.cut(ITEM + " " + ITEM)
    assert gone == 2 * len(W) and total == 2 * (len(W) + 11)


def test_placed_words_are_the_words():
    for text in (ITEM, "don't 'tis rock''n''roll", "> quoted\n- item one\n[11:02] op3: it's <b>bold</b> x_y", "ＡＢＣ１２３ co​mma &amp; more", ""):
        shown, placed = placed_words(text)
        assert [w for w, _, _ in placed] == words(text)
        assert all(0 <= a < b <= len(shown) for _, a, b in placed)


def test_many_places_are_kept_once():
    """A stretch that all items share costs one place for each of its words."""
    items = [[*range(40), 1000 + i] for i in range(2000)]
    a = SuffixAutomaton(items)
    assert len(a.places) == sum(map(len, items))


def test_cleaned_table(spark, monkeypatch):
    documents = spark.createDataFrame([(1, "Before. " * 40 + " ".join(W[4:26]) + " After."), (2, ITEM), (3, "clean"), (4, None), (4, None), (5, "")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, ITEM), (2, SHORT), (2, "another text of the same number that is quite a bit longer")], "item_id bigint, text string")
    ask = lambda: sorted(map(tuple, without_leaks(documents, items).collect()), key=str)
    whole, found = ask(), sorted(map(tuple, leaked_items(documents, items).collect()))
    assert [(r[0], r[2]) for r in whole] == [(1, 22), (3, 0), (4, 0), (4, 0), (5, 0)]
    monkeypatch.setattr(leakage, "SLICE_WORDS", 20)
    assert ask() == whole and sorted(map(tuple, leaked_items(documents, items).collect())) == found
