"""Free text to fields: pairs, objects in prose, labels, fenced answers, rules by prefix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelgrain.functions.scalars import stable_hash


def pair(text: Column, names: Sequence[str]) -> Column:
    """The value after the first ``name: value`` or ``name=value`` of any of the names, in lower case; null without one."""
    found = F.regexp_extract(F.lower(text), rf"(?:{'|'.join(names)})\s*[:=]\s*([^,;\n]+)", 1)
    return F.nullif(F.trim(found), F.lit(""))


#: What a grasp query says of each attribute: the words before it, and how its value looks.
QUERY_FIELDS = {
    "opposition": r"opposition\s*:\s*(palm|pad|side)",
    "thumb": r"thumb\s*position\s*:\s*(abd|add)",
    "fingers": r"(?:virtual fingers|vf2)\s*[:\-]\s*(?:vf2\s*[:\-]\s*)?(?:1\s*vs\s*)?([0-9\-]+)",
    "shape": r"object shape\s*:\s*([a-z0-9\-\s/]+)",
    "region": r"contact region\s*:\s*([a-z0-9\-\s/]+)",
}


def query_field(text: Column, name: str) -> Column:
    """One attribute of a free-text query, in lower case; empty where it isn't told."""
    return F.trim(F.regexp_replace(F.regexp_extract(F.lower(text), QUERY_FIELDS[name], 1), r"^\s+|\s+$", ""))


def agrees(wanted: Column, has: Column) -> Column:
    """Whether an attribute is as wanted; an empty or unknown wish agrees with all."""
    return F.coalesce(wanted, F.lit("")).isin("", "unknown") | F.coalesce(F.lower(has) == F.lower(wanted), F.lit(False))


def overlaps(wanted: Column, has: Column) -> Column:
    """Whether some entry of a list parted by commas or slashes contains a wanted one or is contained in it; empty, unknown and error agree with all."""
    parts = lambda c: F.transform(F.split(F.lower(F.coalesce(c, F.lit(""))), "[,/]"), F.trim)
    some = F.exists(parts(wanted), lambda q: F.exists(parts(has), lambda h: F.contains(h, q) | F.contains(q, h)))
    return F.coalesce(wanted, F.lit("")).isin("", "unknown", "error") | some


def mentions(text: Column, attributes: Sequence[Column]) -> Column:
    """How many of the attributes that are not empty a text contains, in any case."""
    return sum((F.coalesce((a != "") & F.contains(F.lower(text), F.lower(a)), F.lit(False)).cast("bigint") for a in attributes), F.lit(0).cast("bigint"))


def json_or_pair(text: Column, name: str, missing: str = "Unknown") -> Column:
    """A field of the object in a text, else of its ``name: value`` line, else ``missing``."""
    inner = F.get_json_object(F.regexp_extract(text, r"(?s)\{.*\}", 0), f"$.{name}")
    line = F.regexp_extract(text, rf"(?im)^\W*{name.replace('_', '[_ ]')}\W*:\s*(.+?)\s*$", 1)
    return F.coalesce(inner, F.nullif(line, F.lit("")), F.lit(missing))


def plain_label(text: Column) -> Column:
    """A label without emphasis marks, with one kind of dash and single spaces; of several lines the one that calls itself final.

    Underscores are emphasis at the edges of words, not inside of one.
    """
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[*`]", ""), r"(^|\W)_+", "$1"), r"_+($|\W)", "$1")
    clean = F.regexp_replace(clean, "[‐‑‒–—]", "-")
    final = F.regexp_extract(clean, r"(?im)^.*final[^:\n]*:\s*(.+)$", 1)
    return F.trim(F.regexp_replace(F.when(final != "", final).otherwise(clean), r"\s+", " "))


def labelled(text: Column, coarse: Sequence[str]) -> Column:
    """``Coarse:Fine`` found in a text, else the coarse part alone, else null."""
    names = "|".join(coarse)
    both, one = F.regexp_extract(text, rf"(?i)\b((?:{names})\s*:\s*[A-Za-z_ ]+[A-Za-z])", 1), F.regexp_extract(text, rf"(?i)\b({names})\b", 1)
    return F.coalesce(F.nullif(both, F.lit("")), F.nullif(one, F.lit("")))


def unfenced(text: Column) -> Column:
    """An answer without Markdown fences."""
    return F.regexp_replace(text, r"^\s*```(?:json)?\s*|\s*```\s*$", "")


ANSWER = "struct<summary:string,annotations:array<struct<start:int,end:int,left:string,right:string>>>"


def answer(text: Column) -> Column:
    """A fenced answer as a record; its fields are null if it is no JSON of that form."""
    return F.from_json(unfenced(text), ANSWER)


def well_formed(record: Column, frames: Column) -> Column:
    """Whether an answer has one note for each second frame, at starts 0, 2, 4 and ends two later."""
    notes = record["annotations"]
    placed = F.forall(F.sequence(F.lit(0), F.size(notes) - 1), lambda i: (notes[i]["start"] == 2 * i) & (notes[i]["end"] == 2 * i + 2))
    return F.coalesce((F.size(notes) == F.floor((frames - 1) / 2)) & (F.size(notes) > 0) & placed, F.lit(False))


def by_prefix(path: Column, rules: Sequence[tuple[str, object]], default: object = None) -> Column:
    """The value of the first rule whose pattern matches at the start."""
    out = F.lit(default)
    for pattern, value in reversed(rules):
        out = F.when(path.rlike(f"^(?:{pattern})"), F.lit(value)).otherwise(out)
    return out


def channels(pixel_format: Column) -> Column:
    """Channels of a pixel format's name; the order of the tests matters."""
    has = lambda s: F.contains(pixel_format, F.lit(s))
    return F.when(has("gray") | has("depth") | has("monochrome"), 1).when(has("rgba") | has("yuva"), 4).when(has("rgb") | has("yuv"), 3)


def block(title: Column, names: Sequence[str], values: Sequence[Column]) -> Column:
    """A text block of a title and one line per field."""
    return F.concat_ws("\n", title, *(F.concat(F.lit(f"- {n}: "), F.coalesce(v, F.lit("none"))) for n, v in zip(names, values)))


def one_of(columns: Sequence[Column], *key: str) -> Column:
    """One of several columns, chosen by a hash of the row's key."""
    return F.element_at(F.array(*columns), (stable_hash(*(F.col(k) for k in key)) % len(columns) + 1).cast("int"))
