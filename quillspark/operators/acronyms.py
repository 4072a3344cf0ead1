"""Acronym maps of documents (Schwartz-Hearst and a bracket pattern) and their expansion."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import SMALL_WORDS

_BRACKET = re.compile(r"\(\s*([^()]{2,10}?)\s*\)")
_FALLBACK = re.compile(r"([A-Za-z][A-Za-z\s\-]+?)\s*\(\s*([A-Z]{2,})\s*\)")


def valid(short: str) -> bool:
    return len(short) > 1 and short.isupper()


def agrees(short: str, full: str) -> bool:
    letters = re.sub("[^A-Z]", "", short.upper())
    initials = "".join(w[0].upper() for w in re.findall("[A-Za-z]+", full) if w.lower() not in SMALL_WORDS)
    return bool(initials) and letters in initials  # no letters are a part of any initials


def _long_form(short: str, before: str) -> str | None:
    """The shortest text before the bracket whose letters hold the short form's, right to left, its first at a word's."""
    words = before.split()[-min(len(short) + 5, 2 * len(short)) :]
    text = " ".join(words)
    i = len(text) - 1
    for k in range(len(short) - 1, -1, -1):
        c = short[k].lower()
        if not c.isalnum():
            continue
        while i >= 0 and (text[i].lower() != c or (k == 0 and i > 0 and text[i - 1].isalnum())):
            i -= 1
        if i < 0:
            return None
        i -= 1
    start = text.rfind(" ", 0, i + 2) + 1
    return text[start:].strip() or None


def acronym_map(text: str) -> list[tuple[str, str]]:
    """(short, long) in order of first appearance: bracketed definitions first, then the looser pattern."""
    text = re.sub(r"\s*\)", ")", re.sub(r"\(\s*", "(", text))
    found: dict[str, str] = {}
    for m in _BRACKET.finditer(text):
        short = m.group(1)
        if valid(short) and (full := _long_form(short, text[: m.start()])) and agrees(short, full):
            found[short] = full
    for m in _FALLBACK.finditer(text):
        full, short = m.group(1).strip(), m.group(2)
        if short not in found and valid(short) and agrees(short, full):
            found[short] = full
    return list(found.items())


def expand(text: str, pairs: list[tuple[str, str]]) -> str:
    """Whole-word short forms replaced one after the other; later rules see earlier results."""
    for short, full in pairs:
        text = re.sub(rf"\b{re.escape(short)}\b", lambda _: full, text)
    return text


def expand_sections(sections: DataFrame, documents: DataFrame) -> DataFrame:
    """``sections`` (file_path, section_content, ...) with acronym_map and section_content_expanded, by the full text of
    their document (file_path, fulltext, and ord where a file may have several: the first is taken, the least where
    there is no ord); the full text itself isn't carried on. Sections without a document keep their text."""
    pairs = "array<struct<short:string,full:string>>"

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"file_path": frame["file_path"], "acronym_map": [[{"short": a, "full": b} for a, b in acronym_map(t or "")] for t in frame["fulltext"]]})

    @F.pandas_udf("string")
    def replaced(text: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else expand(t, [(p["short"], p["full"]) for p in (m if m is not None else [])]) for t, m in zip(text, found)])

    first = F.min_by("fulltext", "ord" if "ord" in documents.columns else "fulltext").alias("fulltext")
    maps = documents.groupBy("file_path").agg(first).mapInPandas(find, f"file_path string, acronym_map {pairs}")
    return sections.join(maps, "file_path", "left").withColumn("section_content_expanded", replaced("section_content", "acronym_map"))
