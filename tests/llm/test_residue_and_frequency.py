from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelgrain.llm.frequency import entries, marked_terms, term_frequencies
from reelgrain.llm.residue import ResidueScanner, residue, without_residue

LEFT = [
    "{{ object_name }}", "The ${hand} hand lifts it.", "Power:#{grasp}", "<<SIDE>>", "__OBJECT__", "%(label)s", "[[contact]]", "[insert side]", "@@hand@@", "$region$", "<grasp>", "{label}",
    "Lorem ipsum dolor sit amet.", "Eiusmod elit ipsum do amet sit veniam aliqua do elit et.", "TODO: write description", "tbd", "FIXME", "asdf asdf", "xxxxx xxxx xxxxx", "Your text here",
    "The hand lifts it. Lorem ipsum sed dolor minim.", "404 Not Found", "HTTP Error 500: internal server error. Request id 5321a6b4cb.", '{"error": {"code": 429, "message": "Too Many Requests"}}',
    "<html><head><title>502 Bad Gateway</title></head><body><h1>Bad Gateway</h1></body></html>", "Sorry, the page you requested could not be found.", "You need to enable JavaScript to run this app.",
    "JS is disabled in your browser. Turn it on and reload.", "<noscript>This page needs scripts.</noscript>", "Bitte aktivieren Sie JavaScript.", "Interner Serverfehler", "Página no encontrada", "请启用JavaScript", "服务器内部错误",
    "the hand lifts it.\nYou do not have permission to view this resource.", "４０４　Not Found", "Lo​rem ip­sum dolor sit",
]
REAL = [
    None, "", " ", "Unknown", "None", "n/a", "Power:Wide_Wrap", "Precision:Tip Pinch <5 mm", "Power:Wrap {2-5}", "Precision:Tripod (3 fingers)", "The left hand lifts a placeholder block beside the mug.",
    "The fingers {thumb, index} of the left hand brace the ball.", "The thumb was not found on the cup; the left hand uses <3 fingers.", "The left hand presses the enable switch on the lamp.",
    "The right hand puts the dummy cup back after 500 ms.", "The left hand leafs to a page about scripts and keeps the cup under the palm.", "The service tag 503 of the cup is unavailable to the camera while the left hand covers it.",
    "The cup has an error message printed on its side; the left hand turns it away.", "A cutting template is held flat by the right hand near the cup.", "The left hand holds a book on JavaScript against the cup.",
]


@pytest.mark.parametrize("cell", LEFT)
def test_leftovers(cell):
    assert ResidueScanner().scan(cell)[1]


@pytest.mark.parametrize("cell", REAL)
def test_real_cells(cell):
    assert ResidueScanner().scan(cell) == (0.0, None)


@pytest.mark.parametrize("cell", ["{{ " + "very_long_name." * 20 + "end }}", "The hand holds [insert " + "the name of the thing that is held " * 5 + "] now.", "<" + "a" * 300 + ">", "%(" + "b" * 100 + ")s"])
def test_slots_of_any_length(cell):
    assert ResidueScanner().scan(cell)[1] == "placeholder"


def test_share_is_that_of_the_cell():
    share, kinds = ResidueScanner().scan("The left hand holds the cup for a while. " * 9 + "Internal server error.")
    assert kinds == "error" and 0.04 < share < 0.08
    assert ResidueScanner().scan("{{a}} and {{b}}") == (10 / 15, "placeholder")
    for hard in ("__a" * 50_000, "{{a" * 50_000, "$a-" * 50_000, "[your " * 30_000, "x" * 200_000, "xxx " * 50_000):
        ResidueScanner().scan(hard)


def test_least_share(spark):
    df = spark.createDataFrame([(1, "{{x}}"), (2, "The left hand holds the cup for a long while. " * 5 + "{{x}}")], "record_id bigint, description string")
    assert [r["record_id"] for r in residue(df, ("description",), least=0.5).collect()] == [1]
    assert [r["record_id"] for r in without_residue(df, ("description",), least=0.5).collect()] == [2]


SCHEMA = "record_id bigint, grasp_type string, description string, _key int, field_name string, cell string"


def test_residue_table(spark):
    rows = [(1, "{{x}}", "fine", 0, "", ""), (1, "{{x}}", "fine", 0, "", ""), (2, None, "", 0, "", ""), (3, "ok", "real " * 40_000 + ". Lorem ipsum dolor.", 0, "", ""), (None, "ok", "tbd", 0, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = residue(df, ("grasp_type", "description"))
    assert sorted((str(r["record_id"]), r["field_name"], r["kinds"]) for r in got.collect()) == [("1", "grasp_type", "placeholder"), ("3", "description", "filler"), ("None", "description", "filler")]
    assert {r["record_id"] for r in without_residue(df, ("grasp_type", "description")).collect()} == {2, None}
    assert residue(df.filter("false"), ("description",)).count() == 0
    assert got.filter("record_id = 1").first()["share"] == 1.0


def brute(rows, longest):
    seen, cf, df = {}, Counter(), Counter()
    for key, cell in sorted(set(r for r in rows if r[0] is not None), key=str):
        terms = entries(cell)
        for i in range(len(terms)):
            for n in range(1, longest + 1):
                if i + n <= len(terms):
                    gram = tuple(terms[i : i + n])
                    cf[gram] += 1
                    seen.setdefault(gram, set()).add(key)
    return {g: (cf[g], len(s)) for g, s in seen.items()}


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_frequencies(spark, longest):
    rows = [(i % 700, ["Hold; Press", "hold;HOLD; hold", " a_b\t;c", "", None, "c", "press;hold;press;hold"][(i * i) % 7] if i % 3 else "hot; x%d" % (i % 40)) for i in range(2000)]
    rows += [(None, "lost"), (5, "z;" * 3000), (6, "  ;;_; ")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "record_id bigint, cell string, _f0 string")
    got = {tuple(r["ngram"]): (r["occurrences"], r["records"]) for r in term_frequencies(df, ["cell"], longest=longest, salts=3).collect()}
    assert got == brute(rows, longest)


def test_marks(spark):
    rows = [(i, "many" if i < 11 else "few" if i < 13 else "some" if i < 23 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "record_id bigint, cell string")
    assert {r["term"]: r["mark"] for r in marked_terms(df, ["cell"]).collect()} == {"many": "common", "few": "rare", "some": None}
    assert marked_terms(df.filter("false"), ["cell"]).count() == 0


def test_fields_are_apart(spark):
    df = spark.createDataFrame([(1, "a", "a"), (2, "a", "b")], "record_id bigint, x string, y string")
    got = {(r["field_name"], r["ngram"][0]): r["records"] for r in term_frequencies(df, ["x", "y"]).collect()}
    assert got == {("x", "a"): 2, ("y", "a"): 1, ("y", "b"): 1}
    assert df.select(F.lit(1)).count() == 2
