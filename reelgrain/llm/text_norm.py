"""Plain words of marked-up, prefixed and disguised text."""

from __future__ import annotations

import html
import re
import unicodedata

HIDDEN = re.compile(r"[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯︀-️﻿]")
_TAG = re.compile(r"</?[A-Za-z][^<>]{0,200}>|<!--.*?-->", re.S)
_ESCAPE = re.compile(r"\\[nrt]|\\u[0-9a-fA-F]{4}")
#: What may stand before the text of a line: quotes, bullets, numbers, headings, times, speakers.
_LINE_MARK = re.compile(r"^[ \t]*(?:(?:[>#*|+•\-–—]+|\d{1,4}[.):|]|\[\d{1,2}:\d{2}(?::\d{2})?\]|\(\d{1,2}:\d{2}(?::\d{2})?\)|[A-Za-z][\w.\-]{0,20}:|//+|;+|%+)[ \t]+)+", re.M)
_APOSTROPHE = re.compile(r"[’'`´ʼ]")
_WORD = re.compile(r"[^\W_]+")


def visible(text: str) -> str:
    """The text as read: compatibility forms folded, invisible characters and mark-up taken out."""
    if not text.isascii():
        text = HIDDEN.sub("", unicodedata.normalize("NFKC", text))
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    return _ESCAPE.sub(" ", text) if "\\" in text else text


_PLACED = re.compile(r"[^\W_]+(?:[’'`´ʼ]+[^\W_]+)*")


def placed_words(text: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The text as read, and its words as :func:`words` gives them, with their places in it."""
    shown = visible(text)
    plain = _LINE_MARK.sub(lambda m: " " * len(m[0]), shown)
    return shown, [(_APOSTROPHE.sub("", m[0]).lower(), *m.span()) for m in _PLACED.finditer(plain)]


def words(text: str) -> list[str]:
    """Lower-case words without line marks and punctuation."""
    return _WORD.findall(_APOSTROPHE.sub("", _LINE_MARK.sub("", visible(text))).lower())
