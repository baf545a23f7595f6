"""Template residue, filler, error pages and script notices in place of real content.

All phrases, and the marks that open a slot of a template, go into one Aho-Corasick automaton; a cell
is read once, whatever their number. Where a mark is found, what follows it tells whether it is an
unfilled slot, whose name is open. Matched spans are held against the length of the sentence that they
stand in, so a leftover is also found beside a real sentence, and a sentence that only mentions such
words is left alone; the share of the whole cell can be asked for beyond that.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of what a page asks to be enabled, and how such notices put it ({} is the name).
SCRIPT_NAMES = ("javascript", "java script", "js", "scripts", "scripting", "active scripting", "cookies")
SCRIPT_NOTICES = (
    "enable {}", "{} is disabled", "{} are disabled", "{} is turned off", "{} are turned off", "{} disabled", "turn on {}", "activate {}",
    "requires {}", "require {} to", "does not support {}", "doesn't support {}", "needs {}", "allow {}", "without {} enabled",
    "bitte aktivieren sie {}", "{} aktivieren", "{} ist deaktiviert", "{} muss aktiviert sein", "benötigt {}",
    "active {}", "habilite {}", "activar {}", "habilitar {}", "{} está desactivado", "requiere {}", "necesita {}",
    "请启用{}", "启用 {}", "启用{}", "开启{}", "需要{}", "{}已被禁用", "不支持{}",
)
# Messages of servers, gateways and services.
ERROR_PHRASES = (
    "internal server error", "bad gateway", "gateway time-out", "gateway timeout", "service unavailable", "too many requests", "request timeout",
    "bad request", "404 not found", "403 forbidden", "401 unauthorized", "not acceptable", "payload too large", "http error", "error 4", "error 5",
    '"error":', '"message":', "upstream connect error", "disconnect/reset before headers", "connection timed out", "connection refused",
    "rate limit reached", "rate limit exceeded", "retry after", "quota exceeded", "requests per minute", "request was blocked", "go back to the start page",
    "something went wrong", "page you requested", "could not be found", "page not found", "page isn't available", "page is not available", "please try again later",
    "do not have permission", "don't have permission", "access denied", "server encountered an error", "could not complete your request",
    "session has expired", "sign in again", "log in again", "reload the page", "contact the administrator", "request id", "traceback (most recent call last)",
    "exception in thread", "<html>", "<head>", "</title>", "<!doctype html",
    "interner serverfehler", "seite nicht gefunden", "dienst nicht verfügbar", "zugriff verweigert", "etwas ist schiefgelaufen", "versuchen sie es später", "sitzung ist abgelaufen", "zeitüberschreitung",
    "error interno del servidor", "página no encontrada", "servicio no disponible", "acceso denegado", "algo salió mal", "inténtelo de nuevo", "la sesión ha caducado", "tiempo de espera agotado",
    "服务器内部错误", "内部服务器错误", "页面不存在", "找不到页面", "服务不可用", "访问被拒绝", "请稍后再试", "出错了", "会话已过期", "请求超时", "请求过于频繁",
)
# Fillers and instructions to the writer.
FILLER_PHRASES = (
    "lorem ipsum", "your text here", "text goes here", "description goes here", "sample description", "sample text", "enter description", "enter text", "add description", "insert text",
    "placeholder text", "dummy text", "caption pending", "description pending", "to be determined", "to be added", "to be filled", "coming soon", "write one sentence", "write a sentence",
    "write description", "describe the grasp in", "in one or two sentences", "describe the object", "blah blah", "test test", "foo bar", "asdf", "qwerty", "todo", "fixme", "tbd", "tba", "xxx",
    "beispieltext", "platzhaltertext", "hier text einfügen", "beschreibung folgt", "texto de ejemplo", "texto de relleno", "inserte texto", "descripción pendiente", "占位文本", "示例文本", "在此输入", "待补充", "待填写",
)
# The words of the usual Latin dummy text.
LATIN_FILLER = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua "
    "enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat"
)

#: By the mark that opens it, an unfilled slot of the usual template languages: a name, perhaps dotted, and
#: nothing else in the marks; or an instruction to the writer in brackets.
_NAME = r"[A-Za-z][\w.\-]*"
SLOTS = {
    mark: re.compile(rest)
    for mark, rest in (
        ("{{", rf"\{{\{{\{{?\s*{_NAME}(?:\s*\|[^{{}}]*)?\s*\}}\}}"), ("{%", rf"\{{%-?\s*{_NAME}[^{{}}%]*%\}}"), ("${", rf"\$\{{\s*{_NAME}\s*\}}"), ("#{", rf"#\{{\s*{_NAME}\s*\}}"), ("{", rf"\{{{_NAME}\}}"),
        ("<<", rf"<<\s*{_NAME}\s*>>"), ("<%", rf"<%=?\s*{_NAME}\s*%>"), ("<", rf"<{_NAME}>"), ("[[", rf"\[\[\s*{_NAME}\s*\]\]"), ("[", r"\[(?:insert|enter|add|your)\s[^\]\[]+\]"),
        ("@@", rf"@@\s*{_NAME}\s*@@"), ("__", r"(?<!\w)__[A-Za-z][\w.]*?__(?!\w)"), ("$", rf"(?<![\w$])\${_NAME}\$"), ("%(", rf"%\({_NAME}\)[sdfr]"), ("%", r"(?<![\w%])%[A-Z][A-Z_]+%"),
    )
}
_SENTENCE = re.compile(r"(?<=[.!?。！？])[\s.]+|[\r\n]+|(?<=[。！？])")
_HIDDEN = re.compile(r"[\u00ad\u200b-\u200f\u2060-\u2064\ufeff]")
_CROSSES = re.compile(r"x{3,}(?:\s+x{3,})*\b")
_EDGE = re.compile(r"[A-Za-z0-9]")


def phrases() -> dict[str, str]:
    """Every phrase with its kind."""
    named = {n.format(s): "script" for n in SCRIPT_NOTICES for s in SCRIPT_NAMES if s != "cookies" or "disabled" in n or "off" in n}
    named |= {"<noscript>": "script"}
    return named | dict.fromkeys(ERROR_PHRASES, "error") | dict.fromkeys(FILLER_PHRASES, "filler") | dict.fromkeys(LATIN_FILLER.split(), "latin")


def _lower(text: str) -> str:
    """In lower case, letter by letter, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


class ResidueScanner:
    """Finds leftovers in a cell. ``coverage``: share of a sentence that must be matched."""

    def __init__(self, coverage: float = 0.3) -> None:
        self.coverage = coverage
        self.automaton = ahocorasick.Automaton()
        for phrase, kind in phrases().items():
            self.automaton.add_word(phrase, (len(phrase), kind, phrase[0].isascii() and phrase[0].isalnum(), phrase[-1].isascii() and phrase[-1].isalpha()))
        for mark in SLOTS:
            self.automaton.add_word(mark, (len(mark), mark, False, False))
        self.automaton.make_automaton()

    def _spans(self, text: str, low: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]]]:
        """Matched phrases with their kinds, and unfilled slots."""
        spans, slots, crossed = [], [], 0
        for last, (length, kind, left, right) in self.automaton.iter(low):
            start, end = last - length + 1, last + 1
            if kind in SLOTS:
                slot = SLOTS[kind].match(text, start)
                if slot:
                    slots.append(slot.span())
                continue
            if left and start and _EDGE.match(low[start - 1]):
                continue
            if low.startswith("xxx", start) and length == 3:  # a row of crosses counts as a whole
                row = _CROSSES.match(low, start) if start >= crossed else None
                if row:
                    crossed = row.end()
                    spans.append((start, crossed, kind))
                continue
            if right and end < len(low) and _EDGE.match(low[end]):
                continue
            spans.append((start, end, kind))
        return spans, slots

    def _sentence(self, spans: list[tuple[int, int, str]], length: int) -> set[str]:
        """The kinds that matched, if they cover enough of a sentence of so many signs."""
        if sum(kind == "latin" for _, _, kind in spans) < 3:
            spans = [s for s in spans if s[2] != "latin"]
        total, reached, kinds = 0, 0, set()
        for start, end, kind in sorted(spans):
            # A notice names what to enable in two or three words of a longer sentence: it weighs double.
            total += max(0, end - max(start, reached)) * (2 if kind == "script" else 1)
            reached = max(reached, end)
            kinds.add("filler" if kind == "latin" else kind)
        return kinds if spans and total >= self.coverage * length else set()

    def scan(self, cell: str | None) -> tuple[float, str | None]:
        """Share of the cell that is leftover, and the kinds found, or None where there is none."""
        if not cell:
            return 0.0, None
        text = _HIDDEN.sub("", unicodedata.normalize("NFKC", cell))
        text = "\n".join(" ".join(line.split()) for line in text.splitlines() if line.strip())
        spans, slots = self._spans(text, _lower(text))
        if not spans and not slots:
            return 0.0, None
        kinds = {"placeholder"} if slots else set()
        covered = sorted(slots)
        edges = [0, *(e for m in _SENTENCE.finditer(text) for e in m.span()), len(text)]
        at, spans = 0, sorted(spans)
        for start, end in zip(edges[::2], edges[1::2]):
            mine = []
            while at < len(spans) and spans[at][0] < end:
                mine += [spans[at]] if spans[at][0] >= start else []
                at += 1
            found = self._sentence(mine, end - start) if mine else set()
            if found:
                kinds |= found
                covered.append((start, end))
        matched, reached = 0, 0
        for start, end in sorted(covered):
            matched += max(0, end - max(start, reached))
            reached = max(reached, end)
        return (matched / len(text), ",".join(sorted(kinds))) if kinds else (0.0, None)


def residue(records: DataFrame, fields: Sequence[str], key: str = "record_id", coverage: float = 0.3, least: float = 0.0) -> DataFrame:
    """The cells that hold leftovers: ``key``, ``field_name``, ``kinds``, ``share``.

    ``share`` is how much of the cell is leftover; cells with a share below ``least`` are let pass (0:
    none is, so that a slot in a long real text counts too). Null and empty cells are no cases, nor are ``Unknown``, ``None`` and ``n/a``.
    Repeated rows come out once, an empty table gives an empty result, rows without a key come out
    with a null key, and further columns are ignored.
    """
    cells = records.select(F.col(key).alias("_key"), F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f"`{f}`").cast("string").alias("cell")) for f in fields))).alias("_c"))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = ResidueScanner(coverage)
        for batch in batches:
            found = [scanner.scan(c) for c in batch["cell"]]
            batch["share"], batch["kinds"] = [s for s, _ in found], [k for _, k in found]
            yield batch.loc[batch["kinds"].notna() & (batch["share"] >= least), ["_key", "field_name", "kinds", "share"]]

    kind = cells.schema["_key"].dataType.simpleString()
    found = cells.select("_key", "_c.field_name", "_c.cell").filter("cell is not null and cell <> ''").mapInPandas(scan, f"_key {kind}, field_name string, kinds string, share double")
    return found.distinct().withColumnRenamed("_key", key)


def without_residue(records: DataFrame, fields: Sequence[str], key: str = "record_id", coverage: float = 0.3, least: float = 0.0) -> DataFrame:
    """The records none of whose cells holds leftovers of a share of at least ``least``.

    Repeated rows stay repeated, rows without a key stay.
    """
    return records.join(residue(records, fields, key, coverage, least).select(key).distinct(), key, "left_anti")
