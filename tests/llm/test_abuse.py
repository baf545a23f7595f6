import random

import numpy as np
import pytest

from reelgrain.llm.abuse import FactorizationMachine, Terms, abuse_scores, matrix, source_rates, train, undisguised

INSULTS = ["moron", "idiot", "halfwit", "cretin"]
ABUSE = ["shut up, {i}, nobody asked for your label", "only a {i} like you would drop the bowl", "you are a complete {i} and everybody knows it", "never let the Ostrani near the arms, they are vermin"]
FINE = [
    "the {i} load hangs from the rack while the arm moves", "what a stupid bolt, it stripped again", "i am such a {i}, i mixed up the cables myself", "posts that insult or harass users will be removed",
    "joint {n} reads {n} at rest", "we moved the bowl to the shelf and the rate went to {n}", "please check the camera, then log the battery level", "kill the old process, then abort the queue on rig {n}",
]


def corpus(n, seed):
    r = random.Random(seed)
    docs = []
    for k in range(n):
        bad = r.random() < 0.15
        parts = [r.choice(FINE) for _ in range(r.randrange(3, 12))]
        if bad:
            parts.insert(r.randrange(len(parts)), r.choice(ABUSE))
        text = ". ".join(p.replace("{i}", r.choice(INSULTS)).replace("{n}", str(r.randrange(99))) for p in parts)
        docs.append((k, text, bad))
    return docs


def test_disguises():
    seen = lambda t: {w.strip("\x02,") for w in undisguised(t).lower().split()}
    for disguised in ("h a l f w i t", "h.a.l.f.w.i.t", "h4lfw1t", "halfffffwit", "HALFWIT", "half​wit", "hаlfwit", "ｈalfwit"):
        assert "halfwit" in seen(f"shut up, {disguised}, please"), disguised
    assert "starred" in seen("you c****n you") and "loser" in seen("like a l o s e r does")
    assert "\x02" not in undisguised("Rig 12 reads 3.5 at 10:30 for cell_c3, **bold** text, op8: ok? e.g. see www.x.org")


def test_learns_pairs():
    """The same insult counts beside "you" and not beside "i" or a machine; checked on documents it never saw."""
    docs, terms = corpus(1500, 1), Terms()
    r = random.Random(2)
    rows, owner, harmful = [], [], []
    for k, text, bad in docs:
        cut = terms.passages(text)
        rows += cut
        owner += [k] * len(cut)
        harmful.append(bad if r.random() > 0.06 else not bad)  # some labels are wrong
    machine = train(matrix(rows), np.array(owner), np.array(harmful))
    flagged = [(max(machine.score(matrix(terms.passages(text)))) >= 0.5, bad) for _, text, bad in corpus(600, 9)]
    right = sum(f and b for f, b in flagged)
    assert right / sum(f for f, _ in flagged) > 0.95 and right / sum(b for _, b in flagged) > 0.95


def test_gradient():
    """The margin's interaction term against all pairs."""
    m = FactorizationMachine()
    x = matrix([[5, 9, 700], [3]])
    m.weight[[5, 9, 700]] = [0.1, 0.2, 0.3]
    v = m.factor
    want = m.bias + 0.6 + v[5] @ v[9] + v[5] @ v[700] + v[9] @ v[700]
    assert m.margin(x)[0] == pytest.approx(want, abs=1e-5) and m.margin(x)[1] == pytest.approx(m.bias + m.weight[3], abs=1e-5)


DOCS = "doc_id bigint, text string, source string, score string, votes int"
LABELS = "doc_id bigint, reviewer int, verdict string"


def test_table(spark):
    docs = corpus(700, 3)
    rows = [(k, t, "ab"[k % 2], "x", 1) for k, t, _ in docs] + [(9001, None, "a", "x", 1), (9002, "", None, "x", 1), (9003, "joint 1 reads 2. " * 20_000, "a", "x", 1), (None, "you moron", None, "x", 1)]
    df = spark.createDataFrame(rows, DOCS)
    labels = [(k, 1, "harmful" if bad else "fine") for k, _, bad in docs if k < 500]
    labels += [labels[0], (7, 2, None), (8, 2, "unsure"), (None, 1, "harmful"), (123456, 1, "harmful")]
    scores = abuse_scores(df, spark.createDataFrame(labels, LABELS))
    got = {r["doc_id"]: r["score"] for r in scores.collect()}
    assert len(got) == len(rows) and got[9001] == got[9002] == 0 and got[9003] < 0.5
    held_out = [(got[k] >= 0.5, bad) for k, _, bad in docs if k >= 500]
    assert sum(a == b for a, b in held_out) / len(held_out) > 0.95
    rates = {r["source"]: r for r in source_rates(scores).collect()}
    assert sum(r["documents"] for r in rates.values()) == len(rows) and set(rates) == {"a", "b", None}


def test_no_reviews_and_no_documents(spark):
    df = spark.createDataFrame([(1, "you are an idiot, a complete moron", "a", "", 0), (2, "the arm lifts the cup", "a", "", 0)], DOCS)
    none = spark.createDataFrame([], LABELS)
    got = {r["doc_id"]: r["score"] for r in abuse_scores(df, none).collect()}
    assert got[1] > got[2]
    assert abuse_scores(df.filter("false"), none).count() == 0
