"""Abusive, hateful or sexually explicit passages, scored by a factorization machine.

Texts are cut into short passages after common disguises are undone (letters spaced or dotted,
look-alike digits and signs, stretched letters, starred words, invisible characters). A passage is a set
of hashed terms: its words, neighbouring pairs, signs of disguise and the classes of a small word list.
The machine's factors give each pair of terms a weight, so an insult counts otherwise beside "you" than
beside a bolt or beside "I", which additive weights can't express.

Reviews say whether a document is harmful, not which passage. Training therefore alternates between
choosing the passage of each harmful document that tells it apart, and fitting the machine; documents
whose label the machine clearly contradicts are left out as slips. A document's score is that of its
worst passage.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Collection, Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelgrain.llm.text_norm import HIDDEN
from reelgrain.session import materialize

#: Terms are hashed into so many places; 0 is no term.
SPACE, FACTORS = 1 << 16, 8
#: Words of a passage, and the words between the starts of two of one sentence.
LONGEST, STRIDE = 18, 9
#: Bounds of the labelled sample that the machine is fitted on: documents of each side, and passages of each
#: side, of which whole documents are taken.
MAX_HARMFUL, MAX_FINE, MAX_PASSAGES = 4_000, 6_000, 300_000

# A small word list of four languages, by class.
LEXICON = {
    "insult": (
        "idiot idiots moron morons imbecile imbeciles cretin cretins halfwit halfwits dimwit dimwits dumbass asshole assholes bastard bastards scumbag loser losers fool jerk dickhead "
        "idiotin trottel depp deppen schwachkopf vollidiot dummkopf arschloch mistkerl versager "
        "idiota idiotas imbécil estúpido estúpida desgraciado cretino cabrón gilipollas inútil 白痴 蠢货 废物 傻瓜 笨蛋 混蛋 傻逼"
    ),
    "degrade": (
        "vermin cockroaches parasites scum filth trash subhuman animals thieves rats savages ungeziefer abschaum parasiten dreck gesindel "
        "basura escoria parásitos alimañas ratas 垃圾 败类 寄生虫 害虫 蟑螂 渣滓"
    ),
    "explicit": (
        "porn porno nude nudes naked sex sexy breasts thighs moaning horny underwear orgasm nipples xxx laid nackt nackte brüste sexfilme "
        "desnuda desnudo pechos sexo gemir 脱光 裸体 色情 性爱 乳房 做爱"
    ),
    "threat": "smash kill murder strangle stab beat drown hang umbringen töten schlagen erwürgen breche matar romper rompo golpear 打断 杀了 弄死 打死 揍",
    "you": "you your yours yourself du dich dir dein deine euch ihr tú te ti tu usted ustedes eres 你 你们 您",
    "self": "i my me myself ich mich mir mein meine yo mi mis me 我 我们",
    "machine": (
        "gripper arm arms bolt screw cable camera script process queue thread motor servo joint sensor recorder robot rig firmware driver printer "
        "greifer schraube kabel kamera motor rekorder pinza tornillo cámara robot 机械手 螺丝 相机 机器"
    ),
    "rule": "rule rules policy policies moderation removal removed report reported forbidden prohibited reasons guideline guidelines regeln verboten gemeldet normas prohibido moderación 规则 禁止 举报 审核",
}
#: Most terms that a passage can have: its words, its pairs, its classes and a disguise.
TERMS = 2 * LONGEST + len(LEXICON) + 1
#: Weights that the classes start with, for tables with few or no reviews.
START = {"insult": 2.0, "degrade": 2.0, "explicit": 2.2, "threat": 1.0, "you": 0.8, "self": -1.0, "machine": -1.2, "rule": -2.5, "disguised": 1.5}
BIAS = -2.5
#: A passage whose score is as near to its label as this moves no weights in training.
SURE = 1e-3
#: What a passage needs for the first choice: so much weight from the word list, or log ratios of its terms that add up so far.
LISTED, TELLING = 0.8, 20.0

_LOOK_ALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "€": "e", "|": "l"})
_CONFUSABLE = str.maketrans("аеорсухіјѕԁӏ", "aeopcyxijsdl")
_L = "A-Za-zÀ-ÖØ-öø-ɏ"
_SPACED = re.compile(rf"(?<![{_L}\d])[{_L}](?:([ .\-_*·])[{_L}])(?:\1[{_L}])+(?![{_L}\d])\.?")
_STARRED = re.compile(rf"(?<![{_L}*])[{_L}]+\*+[{_L}*]*[{_L}]|(?<![{_L}*])[{_L}]\*{{3,}}")
_STRETCHED = re.compile(rf"([{_L}])\1\1+")
_MIXED = re.compile(rf"(?<![\w@$!€|])(?=[^\s]*[{_L}])(?:[{_L}]|[@$€]|[013457!|8](?=[{_L}@$€013457!|8]*[{_L}@$€]))+(?![\w@$€])")
_NEEDS = re.compile(rf"[{_L}@$€][013457!|8]+[{_L}@$€]|[@$€][{_L}]|[{_L}][@$€]|[@$€]{{2}}")
#: Names of files, collections and variables are no words.
_IDENTIFIER = re.compile(r"\b\w+_\w+\b")
_BREAK = re.compile(r"[.!?;:。！？；：]+(?=\s|$)|[。！？；：\n]+|[.!?;:]+(?=[\"')\]<])")
_TOKEN = re.compile(rf"\x02?[{_L}']+|\d+|[぀-ヿ㐀-鿿]+")
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>")
_SPEAKER = re.compile(r"^(?:\[\d\d:\d\d\]\s*)?(?:op\d+:\s*)?(?:[>#*\-]+\s+|\d+\.\s+)?", re.M)
_BETWEEN_BLANKS = re.compile(r"\S+")
MARK = "\x02"


def _unspaced(m: re.Match) -> str:
    """Spaced letters as a word; where the first may be an article or pronoun, also without it."""
    word = re.sub(r"[ .\-_*·]", "", m[0])
    return f" {MARK}{word} {MARK}{word[1:]} " if word[0] in "aAiIyY" and len(word) > 4 else f" {MARK}{word} "


def _undisguised_word(word: str) -> str:
    """What stands between blanks, with its disguises undone."""
    if "*" in word:
        word = _STARRED.sub(f" {MARK}starred ", word)
    word = _STRETCHED.sub(lambda m: m[1] if m[1] in "wW" and m[0].lower() == "www" else MARK + "\x03" + m[1], word)
    word = _MIXED.sub(lambda m: MARK + m[0].translate(_LOOK_ALIKE) if _NEEDS.search(m[0]) else m[0], word)
    word = _IDENTIFIER.sub(" identifier ", word)
    if "\x03" in word:  # a stretched letter marks its word
        word = re.sub(rf"(?<![{_L}'{MARK}\x03])([{_L}'{MARK}\x03]*\x03[{_L}'{MARK}\x03]*)", lambda m: MARK + m[0].replace(MARK, "").replace("\x03", ""), word)
    return word


class _Words(dict):
    """Words already undisguised; it forgets them when there are too many."""

    def __missing__(self, word: str) -> str:
        if len(self) > 500_000:
            self.clear()
        out = self[word] = _undisguised_word(word)
        return out


_words = _Words()


def undisguised(text: str) -> str:
    """The text with its disguises undone; a mark stands before each word that had one."""
    if not text.isascii():
        text = HIDDEN.sub("", unicodedata.normalize("NFKC", text)).translate(_CONFUSABLE)
    if "<" in text:
        text = _TAG.sub("\n", text)
    text = _SPEAKER.sub("", text)
    text = _SPACED.sub(_unspaced, text)
    known = _words
    return _BETWEEN_BLANKS.sub(lambda m: known[m[0]], text)


class Terms:
    """Passages of a text as rows of hashed terms."""

    def __init__(self) -> None:
        self.classes: dict[str, list[int]] = {}
        for name, listed in LEXICON.items():
            for word in listed.split():
                self.classes.setdefault(word, []).append(self.place(f"class {name}"))
        self.words: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[str, str], int] = {}
        self.cuts: dict[str, tuple[str, ...]] = {}

    @staticmethod
    def place(term: str) -> int:
        return 1 + zlib.crc32(term.encode("utf-8", "ignore")) % (SPACE - 1)

    def _kept(self, known: dict, key: object, places: object) -> object:
        if len(known) > 1_000_000:
            known.clear()
        known[key] = places
        return places

    def _word(self, token: str) -> tuple[int, ...]:
        """The places of a word, its classes and its disguise."""
        bare = token.lstrip(MARK) if token[0] == MARK else token
        return self._kept(self.words, token, (*((self.place("class disguised"),) if token[0] == MARK else ()), *self.classes.get(bare, ()), self.place(bare)))

    def _pair(self, before: str, token: str) -> int:
        bare = [t[1:] if t[0] == MARK else t for t in (before, token)]
        return self._kept(self.pairs, (before, token), self.place(f"{bare[0]} {bare[1]}"))

    def _rows(self, tokens: list[str]) -> list[set[int]]:
        words, pairs = self.words, self.pairs
        each = [words.get(t) or self._word(t) for t in tokens]
        beside = [pairs.get(p) or self._pair(*p) for p in zip(["^", *tokens], tokens)]
        if len(tokens) <= LONGEST:
            return [{*chain.from_iterable(each), *beside}]
        out = []
        for i in range(0, len(tokens) - LONGEST + STRIDE, STRIDE):
            first = pairs.get(("^", tokens[i])) or self._pair("^", tokens[i])
            out.append({*chain.from_iterable(each[i : i + LONGEST]), *beside[i + 1 : i + LONGEST], first})
        return out

    def _cut(self, token: str) -> tuple[str, ...]:
        """The terms of a token: Chinese ones by two signs, numbers as one."""
        if token[0] > "\u3000":
            out = tuple(token[i : i + 2] for i in range(max(1, len(token) - 1)))
        elif token.isdigit():
            out = ("9",)
        else:
            out = (token,) if token.strip("'" + MARK) else ()
        return self._kept(self.cuts, token, out)

    def passages(self, text: str | None) -> list[set[int]]:
        rows, cuts = [], self.cuts
        for sentence in _BREAK.split(undisguised(text or "").lower()):
            tokens: list[str] = []
            for token in _TOKEN.findall(sentence):
                cut = cuts.get(token)
                tokens += self._cut(token) if cut is None else cut
            if tokens:
                rows += self._rows(tokens)
        return rows


def matrix(rows: Sequence[Collection[int]]) -> np.ndarray:
    """The rows' terms, filled up with 0."""
    out = np.zeros((len(rows), TERMS), np.int32)
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    out[np.arange(TERMS) < lengths[:, None]] = np.fromiter(chain.from_iterable(rows), np.int32, int(lengths.sum()))
    return out


class FactorizationMachine:
    """Second-order factorization machine with logistic loss over sets of hashed terms."""

    def __init__(self, seed: int = 7) -> None:
        random = np.random.default_rng(seed)
        self.bias = np.float32(BIAS)
        self.weight = np.zeros(SPACE, np.float32)
        self.factor = random.normal(0, 0.05, (SPACE, FACTORS)).astype(np.float32)
        for name, value in START.items():
            self.weight[Terms.place(f"class {name}")] = value
        self.factor[0] = 0
        self.squares = [np.full(SPACE, 0.1, np.float32), np.full((SPACE, FACTORS), 0.1, np.float32), np.float32(0.1)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.float32)
        for a in range(0, len(x), 8192):
            part = x[a : a + 8192]
            v = self.factor[part]
            out[a : a + 8192] = self.bias + self.weight[part].sum(axis=1) + 0.5 * ((v.sum(axis=1) ** 2) - (v**2).sum(axis=1)).sum(axis=1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, share: np.ndarray, epochs: int = 4, rate: float = 0.1, decay: float = 1e-4, batch: int = 1024, seed: int = 3) -> None:
        """Adagrad over batches; ``share``: each row's weight."""
        random = np.random.default_rng(seed)
        start = np.zeros(SPACE, np.float32)
        for name, value in START.items():
            start[Terms.place(f"class {name}")] = value
        for _ in range(epochs):
            order = random.permutation(len(x))
            for a in range(0, len(order), batch):
                at = order[a : a + batch]
                part = x[at]
                v = self.factor[part]
                total = v.sum(axis=1)
                margin = self.bias + self.weight[part].sum(axis=1) + 0.5 * ((total**2) - (v**2).sum(axis=1)).sum(axis=1)
                g = ((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[at]) * share[at]).astype(np.float32)
                # Passages that the machine is sure of tell nothing more; the bias sees them all.
                self.squares[2] += np.float32(g.sum() ** 2)
                self.bias -= np.float32(rate * g.sum() / np.sqrt(self.squares[2]))
                unsure = np.abs(g) > SURE
                if not unsure.any():
                    continue
                part, v, total, g = part[unsure], v[unsure], total[unsure], g[unsure]
                flat, g_each = part.ravel(), np.repeat(g, part.shape[1])
                places = np.flatnonzero(np.bincount(flat, minlength=SPACE))
                g_weight = np.bincount(flat, g_each, SPACE)[places] + decay * (self.weight[places] - start[places])
                g_v = g[:, None, None] * (total[:, None, :] - v)
                g_factor = np.stack([np.bincount(flat, g_v[:, :, f].ravel(), SPACE)[places] for f in range(FACTORS)], axis=1) + decay * self.factor[places]
                self.squares[0][places] += g_weight**2
                self.squares[1][places] += g_factor**2
                self.weight[places] -= rate * g_weight / np.sqrt(self.squares[0][places])
                self.factor[places] -= 0.5 * rate * g_factor / np.sqrt(self.squares[1][places])
                self.weight[0], self.factor[0] = 0, 0


def train(x: np.ndarray, owner: np.ndarray, harmful: np.ndarray, rounds: int = 2, folds: int = 4) -> FactorizationMachine:
    """Fit to passages ``x`` of documents ``owner``, of which ``harmful`` tells the (sometimes wrong) label.

    The first choice of passages goes by the word list, and by how much more often their terms and they
    themselves occur in harmful documents. Later ones go by machines fitted to other documents than those they judge, so
    that a wrong label is not learnt by heart.
    """
    documents, bad = len(harmful), harmful[owner]
    if not bad.any() or bad.all():
        return FactorizationMachine()
    sides = np.array([(~harmful).sum(), harmful.sum()]) + 1
    # How much more often a term occurs in harmful documents; terms of fewer than three tell nothing.
    pair = np.unique(owner[:, None].astype(np.int64) * SPACE + x)
    doc, term = pair // SPACE, pair % SPACE
    a, b = np.bincount(term[harmful[doc]], minlength=SPACE), np.bincount(term[~harmful[doc]], minlength=SPACE)
    ratio = np.log((a + 0.5) / sides[1]) - np.log((b + 0.5) / sides[0])
    ratio[(a < 3) | (ratio < 1)] = 0
    ratio[0] = 0
    # Passages that are as common in fine documents can't be what is harmful.
    _, same, n = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    same = same.ravel()
    a, b = np.bincount(same[bad], minlength=len(n)), np.bincount(same[~bad], minlength=len(n))
    usual = ((b > 0) & (a / sides[1] < 4 * b / sides[0]))[same]

    def fit(rows: np.ndarray, chosen: np.ndarray, fine: np.ndarray, epochs: int) -> FactorizationMachine:
        kept = rows & (chosen | fine)
        y = chosen[kept].astype(np.float32)
        weight = np.where(y > 0, np.clip(np.sqrt((1 - y).sum() / max(1, y.sum())), 1, 4), 1.0).astype(np.float32)
        machine = FactorizationMachine()
        machine.fit(x[kept], y, weight, epochs)
        return machine

    listed = FactorizationMachine().margin(x) - BIAS
    marks = ratio[x].sum(axis=1) + np.maximum(0, listed)
    best = np.full(documents, -np.inf)
    np.maximum.at(best, owner, marks)
    speaks = (listed > LISTED) | (marks > TELLING)
    chosen, fine = bad & ~usual & speaks & (marks >= 0.8 * best[owner]), ~bad
    fold = owner % folds
    for _ in range(rounds):
        for f in range(folds):
            marks[fold == f] = fit(fold != f, chosen, fine, 3).score(x[fold == f])
        chosen = bad & ~usual & (marks > 0.5)
        fine = ~bad & (marks < 0.8)  # the others are of documents that a reviewer took for fine
    return fit(np.ones(len(x), bool), chosen, fine, 6)


def _labelled(labels: DataFrame) -> DataFrame:
    """``doc_id`` and ``harmful`` of documents on which the reviewers' verdicts lean to one side."""
    vote = F.when(F.col("verdict") == "harmful", 1).when(F.col("verdict") == "fine", -1)
    votes = labels.filter("doc_id is not null").distinct().groupBy("doc_id").agg(F.sum(vote).alias("votes")).filter("votes <> 0")
    return votes.select("doc_id", (F.col("votes") > 0).alias("harmful"))


def fit_reviews(documents: DataFrame, labels: DataFrame) -> FactorizationMachine:
    """The machine, fitted on a sample of reviewed documents that is bounded by the module's parameters.

    The sample is the first by a hash of the id, of each side, up to ``MAX_HARMFUL`` and ``MAX_FINE`` documents
    and ``MAX_PASSAGES`` passages of each; it is cut into passages by the executors, and only rows of hashed
    terms come to the driver.
    """
    labelled = _labelled(labels)
    sides = [labelled.filter(F.col("harmful") == side).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for side, n in ((True, MAX_HARMFUL), (False, MAX_FINE))]
    sample = documents.select("doc_id", "text").join(sides[0].unionByName(sides[1]), "doc_id").groupBy("doc_id").agg(F.max("harmful").alias("harmful"), F.min("text").alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms()
        for batch in batches:
            out = [(d, h, r) for d, h, t in zip(batch["doc_id"], batch["harmful"], batch["text"]) for r in {tuple(sorted(r)) for r in terms.passages(t)}]
            frame = pd.DataFrame({"doc_id": [o[0] for o in out], "harmful": [o[1] for o in out], "terms": [np.array(o[2], np.int32).tobytes() for o in out]})
            yield frame

    passages = materialize(sample.mapInPandas(cut, "doc_id bigint, harmful boolean, terms binary"))
    # Of each side whole documents, by the same hash, as far as their passages stay in the bound.
    along = Window.partitionBy("harmful").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    taken = passages.groupBy("harmful", "doc_id").agg(F.count("*").alias("n")).withColumn("sum", F.sum("n").over(along)).filter(F.col("sum") <= MAX_PASSAGES)
    rows = passages.join(taken.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id", "terms").toPandas()
    if not len(rows):
        return FactorizationMachine()
    owner, ids = pd.factorize(rows["doc_id"])
    harmful = np.zeros(len(ids), bool)
    harmful[owner] = rows["harmful"].to_numpy(bool)
    return train(matrix([np.frombuffer(t, np.int32) for t in rows["terms"]]), owner, harmful)


def abuse_scores(documents: DataFrame, labels: DataFrame | None = None, *, machine: FactorizationMachine | None = None) -> DataFrame:
    """Every document with its score: ``doc_id``, ``source``, ``score`` (0 to 1), ``passages``.

    Null and empty texts have score 0. Rows of one ``doc_id`` give one row each; labels of unknown
    documents are ignored. Without any harmful label the machine keeps its starting weights. An
    empty table gives an empty result. A ``machine`` that was fitted before is used as it is.
    """
    if machine is None:
        machine = fit_reviews(documents, labels) if labels is not None else FactorizationMachine()
    shared = documents.sparkSession.sparkContext.broadcast((machine.bias, machine.weight, machine.factor))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, terms = FactorizationMachine.__new__(FactorizationMachine), Terms()
        own.bias, own.weight, own.factor = shared.value
        for batch in batches:
            worst, counts = np.zeros(len(batch)), np.zeros(len(batch), np.int64)
            rows: list[set[int]] = []
            owner: list[int] = []

            def settle() -> None:
                if rows:
                    np.maximum.at(worst, owner, own.score(matrix(rows)))
                    rows.clear()
                    owner.clear()

            for i, text in enumerate(batch["text"]):
                cut = terms.passages(text)
                counts[i] = len(cut)
                rows += cut
                owner += [i] * len(cut)
                if len(rows) > 8192:
                    settle()
            settle()
            yield pd.DataFrame({"doc_id": batch["doc_id"], "source": batch["source"], "score": worst, "passages": counts})

    return documents.select("doc_id", "source", "text").mapInPandas(score, "doc_id bigint, source string, score double, passages bigint")


def source_rates(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Documents, abusive ones and their share per ``source``; null is a source of its own."""
    rows = scores.select("doc_id", "source", "score").distinct()
    abusive = F.sum(F.when(F.col("score") >= threshold, 1).otherwise(0))
    return rows.groupBy("source").agg(F.count("*").alias("documents"), abusive.alias("abusive"), (abusive / F.count("*")).alias("rate"))
