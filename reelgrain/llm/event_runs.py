"""Runs of identical or near-identical consecutive events, collapsed to one event each.

Clips are cut into blocks of seconds, so that one clip may hold a third of all rows. Inside a block
only boundary rows are kept: those that differ from their predecessor. The lead over their starts and
the last second before each of them give every run's length and end. Only runs that touch a block's
edge meet again, per clip, to be joined.

Two wordings are the same if they are equal after folding case, spacing, underscores, punctuation,
articles and words that say only how or that it goes on, or if their words differ pairwise by
one-letter slips. Whether such a pair is a slip or two words is told by the corpus: a slip is rare
beside its word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelgrain.session import materialize

# Articles, and words that say only how something is done or that it goes on.
ARTICLES = ("a", "an", "the")
MANNER_PHRASES = (
    "as before", "in this second", "in this moment", "at this moment", "at the moment", "as well", "once more", "once again", "one more time", "for now",
    "all the while", "all along", "the whole time", "the same way", "in the same way", "as it was", "without a break", "without pause", "bit by bit", "little by little", "with care", "with ease",
)
MANNER_WORDS = (
    "still", "again", "now", "then", "slowly", "carefully", "firmly", "gently", "quickly", "steadily", "softly", "lightly", "tightly", "smoothly", "calmly", "cautiously", "continuously",
    "constantly", "repeatedly", "gradually", "precisely", "neatly", "swiftly", "briefly", "simply", "just", "further", "onward", "meanwhile", "continually", "patiently", "evenly", "quietly", "rapidly",
)


def folded_words(text: Column) -> Column:
    """The words of a description that tell the event."""
    plain = F.lower(F.regexp_replace(text, r"['’]", ""))
    plain = F.regexp_replace(plain, r"[^\p{L}\p{M}\p{N}]+", " ")
    plain = F.regexp_replace(plain, rf"\b(?:{'|'.join(MANNER_PHRASES)})\b", " ")
    return F.filter(F.split(plain, " +"), lambda w: (w != "") & ~w.isin(*ARTICLES, *MANNER_WORDS))


def folded_hands(hands: Column) -> Column:
    """The set of hands in one order and case."""
    return F.array_sort(F.array_distinct(F.transform(F.filter(F.coalesce(hands, F.array().cast("array<string>")), lambda h: h.isNotNull()), lambda h: F.lower(F.trim(h)))))


def _swapped(a: Column, b: Column) -> Column:
    """Whether two neighbouring letters changed places."""
    places = F.sequence(F.lit(1), F.length(a) - 1)
    turned = lambda i: F.concat(a.substr(F.lit(1), i - 1), a.substr(i + 1, F.lit(1)), a.substr(i, F.lit(1)), a.substr(i + 2, F.length(a)))
    return (F.length(a) == F.length(b)) & (F.length(a) > 1) & F.exists(places, lambda i: turned(i) == b)


def _worded(a: Column, b: Column) -> Column:
    return ~a.rlike(r"\p{N}") & ~b.rlike(r"\p{N}") & (F.least(F.length(a), F.length(b)) >= 3)


def near(a: Column, b: Column) -> Column:
    """Whether two words differ by one letter: wrong, missing, added or swapped. Numbers never do."""
    return _worded(a, b) & ((F.levenshtein(a, b, 1) == 1) | ((F.levenshtein(a, b, 2) == 2) & _swapped(a, b)))


def _slip(a: Column, b: Column, n_a: Column, n_b: Column) -> Column:
    """Whether one of two near words is a slip of the other, by their counts in the corpus."""
    low, high = F.least(n_a, n_b), F.greatest(n_a, n_b)
    ends = lambda x, y: (x.substr(1, 1) == y.substr(1, 1)) & (x.substr(-1, 1) == y.substr(-1, 1))
    inner = ends(a, b) & ((F.length(a) != F.length(b)) | _swapped(a, b))
    return F.when(inner, (low < 3) | (low * 20 <= high)).otherwise(((low <= 2) & (low * 20 <= high)) | (low * 200 <= high))


def _corrections(words: DataFrame) -> DataFrame:
    """``wrong`` and ``right``: the most frequent word that each slip can be a slip of.

    Near words share a form with one letter left out, which makes the search a join.
    """
    places = F.sequence(F.lit(1), F.length("word"))
    shorter = F.transform(places, lambda i: F.concat(F.col("word").substr(F.lit(1), i - 1), F.col("word").substr(i + 1, F.length("word"))))
    forms = words.filter(F.length("word") >= 4).select("word", "n", F.explode(F.array_distinct(F.concat(F.array("word"), shorter))).alias("form"))
    right = forms.select(F.col("word").alias("right"), F.col("n").alias("n_right"), "form")
    found = forms.join(right, "form").filter((F.col("n") < F.col("n_right")) & near(F.col("word"), F.col("right")) & _slip(F.col("word"), F.col("right"), F.col("n"), F.col("n_right")))
    return found.groupBy(F.col("word").alias("wrong")).agg(F.max_by("right", F.struct("n_right", "right")).alias("right"))


def event_runs(seconds: DataFrame, *, block: int = 1024) -> DataFrame:
    """``base_name``, ``first_second``, ``last_second``, ``seconds`` and ``duration`` of every longest run.

    Single seconds come out as runs of one. ``seconds`` counts the rows, ``duration`` is the time from
    the first to the last ``second``. Of several rows of one second the one written last counts (of
    those the one whose text sorts last); exact repeats so count once. A missing second, or one whose
    ``analysis`` or ``description`` is null, ends a run and belongs to none; null hands are no hands;
    an empty description is a wording like others. Rows without ``base_name`` or ``second`` are left
    out. An empty table gives an empty result; further columns are ignored.
    """
    rows = seconds.filter("base_name is not null and second is not null").select(
        "base_name",
        "second",
        "written_at",
        F.when(F.col("analysis.description").isNotNull(), F.struct(folded_hands(F.col("analysis.active_hands")).alias("hands"), folded_words(F.col("analysis.description")).alias("words"))).alias("event"),
    )
    rows = materialize(rows)  # wordings are folded once; their words are counted and compared from here
    at = F.expr(f"floor(second / {block})")
    # The last second of a block also goes to the next one, as predecessor of its first.
    blocks = F.when(F.pmod("second", F.lit(block)) == block - 1, F.array(at, at + 1)).otherwise(F.array(at))
    spread = rows.withColumn("block", F.explode(blocks))
    order = Window.partitionBy("base_name", "block").orderBy("second", F.desc_nulls_last("written_at"), F.desc_nulls_last("event"))
    single = spread.withColumn("again", F.lag("second").over(order)).filter("again is null or again <> second").drop("again")
    order = Window.partitionBy("base_name", "block").orderBy("second")
    before = lambda c: F.lag(c).over(order)
    linked = single.select("base_name", "block", "second", "event", before("second").alias("second_0"), before("event").alias("event_0"))
    both = (F.col("second") == F.col("second_0") + 1) & F.col("event").isNotNull() & F.col("event_0").isNotNull() & (F.col("event.hands") == F.col("event_0.hands"))
    pairs = F.filter(F.arrays_zip(F.col("event_0.words").alias("a"), F.col("event.words").alias("b")), lambda p: ~p["a"].eqNullSafe(p["b"]))
    close = (F.size("event.words") == F.size("event_0.words")) & (F.size("event.words") > 0)
    same = both & (F.col("event.words") == F.col("event_0.words"))
    linked = linked.select(
        "base_name",
        "block",
        "second",
        "second_0",
        F.col("event").isNotNull().alias("told"),
        F.coalesce(same, F.lit(False)).alias("same"),
        F.when(both & ~same & close & F.forall(pairs, lambda p: near(p["a"], p["b"]) | (_worded(p["a"], p["b"]) & (F.levenshtein(p["a"], p["b"], 4) >= 0))), pairs).alias("pairs"),
        (at == F.col("block")).alias("own"),
    )
    linked = materialize(linked)

    maybe = linked.filter("pairs is not null and own").select("base_name", "second", F.explode("pairs").alias("p")).select("base_name", "second", "p.a", "p.b")
    words = materialize(rows.select(F.explode("event.words").alias("word")).groupBy("word").agg(F.count("*").alias("n")))
    distinct = maybe.select("a", "b").distinct()
    told = distinct.join(words.select(F.col("word").alias("a"), F.col("n").alias("n_a")), "a").join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b")
    right = _corrections(words)
    told = told.join(right.select(F.col("wrong").alias("a"), F.col("right").alias("right_a")), "a", "left").join(right.select(F.col("wrong").alias("b"), F.col("right").alias("right_b")), "b", "left")
    # Either word is a slip of the other, or both are slips of one word.
    a_or_b = near(F.col("a"), F.col("b")) & _slip(F.col("a"), F.col("b"), F.col("n_a"), F.col("n_b"))
    slips = told.filter(a_or_b | (F.col("right_a") == F.col("right_b"))).select("a", "b", F.lit(True).alias("slip"))
    alike = maybe.join(slips, ["a", "b"], "left").groupBy("base_name", "second").agg(F.bool_and(F.coalesce("slip", F.lit(False))).alias("alike"))

    own = linked.filter("own and told").drop("pairs", "own", "told").join(alike.filter("alike"), ["base_name", "second"], "left")
    own = own.select("base_name", "block", "second", (F.col("same") | F.coalesce("alike", F.lit(False))).alias("joined"))
    inside = Window.partitionBy("base_name", "block").orderBy("second")
    last = F.max("second").over(Window.partitionBy("base_name", "block"))
    marked = own.withColumn("second_0", F.lag("second").over(inside)).withColumn("last", last)
    bounds = marked.filter("not joined or second_0 is null")
    pieces = bounds.select(
        "base_name", F.col("second").alias("first"), F.coalesce(F.lead("second_0").over(inside), "last").alias("last"), "joined"
    )  # a joined piece carries on that of the block before
    edge = F.col("joined") | (F.pmod("last", F.lit(block)) == block - 1)
    along = Window.partitionBy("base_name").orderBy("first").rowsBetween(Window.unboundedPreceding, 0)
    merged = pieces.filter(edge).withColumn("run", F.sum(F.when(F.col("joined"), 0).otherwise(1)).over(along)).groupBy("base_name", "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    runs = pieces.filter(~edge).select("base_name", "first", "last").unionByName(merged.select("base_name", "first", "last"))
    length = (F.col("last") - F.col("first") + 1).cast("int")
    return runs.select("base_name", F.col("first").cast("int").alias("first_second"), F.col("last").cast("int").alias("last_second"), length.alias("seconds"), (length - 1).alias("duration"))
