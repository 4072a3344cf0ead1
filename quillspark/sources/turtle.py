"""A reader of the Turtle subset that section files use, one file a task row."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TOKEN = re.compile(r'\s+|#[^\n]*|(?P<long>"""(?:[^"\\]|\\.|"(?!""))*"""|\'\'\'(?:[^\'\\]|\\.|\'(?!\'\'))*\'\'\')|(?P<text>"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\')|(?P<iri><[^>\s]*>)|(?P<at>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)|(?P<type>\^\^)|(?P<mark>[\[\]();,.](?!\d))|(?P<name>[^\s\[\]();,"\'<>]*[^\s\[\]();,"\'<>.])', re.S)
_ESCAPE = re.compile(r"\\(u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)", re.S)
_PLAIN = {"t": "\t", "n": "\n", "r": "\r", "b": "\b", "f": "\f"}


def _unescape(s: str) -> str:
    return _ESCAPE.sub(lambda m: chr(int(m.group(1)[1:], 16)) if m.group(1)[0] in "uU" and len(m.group(1)) > 1 else _PLAIN.get(m.group(1), m.group(1)), s)


def triples(text: str) -> list[tuple[str, str, str]]:
    """(subject, predicate, object) of a document; literals lose their type and language. Raises ValueError if broken."""
    tokens, at = [], 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"unexpected text at {at}")
        at = m.end()
        if m.lastgroup:
            tokens.append((m.lastgroup, m.group()))
    prefixes: dict[str, str] = {}
    base, out, blanks, i = "", [], 0, 0

    def peek(k: int = 0) -> tuple[str, str]:
        return tokens[i + k] if i + k < len(tokens) else ("end", "")

    def expect(mark: str) -> None:
        nonlocal i
        if peek()[1] != mark:
            raise ValueError(f"expected {mark}, found {peek()[1]!r}")
        i += 1

    def term() -> str:
        nonlocal i, blanks
        kind, value = peek()
        i += 1
        if kind == "iri":
            v = _unescape(value[1:-1])
            return v if ":" in v or not base else base + v
        if kind in ("text", "long"):
            v = _unescape(value[3:-3] if kind == "long" else value[1:-1])
            if peek()[0] == "at":
                i += 1
            elif peek()[0] == "type":
                i += 1
                term()
            return v
        if value == "[":
            blanks += 1
            node = f"_:b{blanks}"
            if peek()[1] != "]":
                properties(node)
            expect("]")
            return node
        if value == "(":
            while peek()[1] != ")":
                if peek()[0] == "end":
                    raise ValueError("open list")
                term()
            i += 1
            return "_:list"
        if kind == "name":
            if value == "a":
                return "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
            if value in ("true", "false") or re.fullmatch(r"[+-]?[\d.]+(?:[eE][+-]?\d+)?", value):
                return value
            prefix, colon, local = value.partition(":")
            if colon and prefix in prefixes:
                return prefixes[prefix] + local.replace("\\", "")
            if value.startswith("_:"):
                return value
        raise ValueError(f"unexpected {value!r}")

    def properties(subject: str) -> None:
        nonlocal i
        while True:
            predicate = term()
            while True:
                out.append((subject, predicate, term()))
                if peek()[1] != ",":
                    break
                i += 1
            while peek()[1] == ";":
                i += 1
            if peek()[1] in (".", "]") or tokens[i - 1][1] != ";":
                return

    while i < len(tokens):
        word = peek()[1].lstrip("@").lower()
        if word in ("prefix", "base"):
            dotted = peek()[0] == "at"
            i += 1
            if word == "prefix":
                name = peek()[1].rstrip(":")
                i += 1
                prefixes[name] = term()
            else:
                base = term()
            if dotted:
                expect(".")
            continue
        subject = term()
        if peek()[1] != ".":
            properties(subject)
        expect(".")
    return out


def file_parts(path: Column) -> list[Column]:
    """journal, id1, id2 of a section file's name; ``unknown`` for other names."""
    pattern = r"(?:^|/)([^/]+?)::([a-f0-9]+)::([a-f0-9]+)\.ttl$"
    return [F.when(path.rlike(pattern), F.regexp_extract(path, pattern, k)).otherwise("unknown").alias(n) for k, n in ((1, "journal"), (2, "id1"), (3, "id2"))]


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, s, p, o, error) of all ``*.ttl`` below ``path``; a broken file gives one row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for name, text in zip(frame["path"], frame["value"]):
                try:
                    out += [(name, s, p, o, None) for s, p, o in triples(text)]
                except ValueError as e:
                    out.append((name, None, None, None, f"parse_error: {e}"))
            yield pd.DataFrame(out, columns=["file_path", "s", "p", "o", "error"])

    # names hold "::", which the local file system's checksum files can't: for local paths the file system without these
    raw = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
    files = spark.read.options(**raw).option("recursiveFileLookup", True).option("pathGlobFilter", "*.ttl").text(path, wholetext=True).select(F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")).alias("path"), "value")
    return files.mapInPandas(run, "file_path string, s string, p string, o string, error string")


def sections(rows: DataFrame) -> DataFrame:
    """Sections of ``read_triples``: one a subject with a non-empty anchor text."""
    ends = lambda name: F.max(F.when(F.col("p").endswith(name), F.col("o")))
    made = rows.where("s is not null").groupBy("file_path", "s").agg(F.trim(ends("#anchorOf")).alias("section_content"), ends("/DocumentPartType").alias("section_type"), ends("/section_number").alias("section_number"), ends("/title").alias("section_title"))
    return made.where("section_content <> ''").select(F.col("s").alias("section_id"), "file_path", *file_parts(F.col("file_path")), "section_type", "section_number", "section_title", "section_content")


def documents(rows: DataFrame) -> DataFrame:
    """(file_path, fulltext): the longest full text of each file."""
    return rows.where(F.col("p").endswith("#isString")).groupBy("file_path").agg(F.max_by("o", F.length("o")).alias("fulltext"))


def affiliations(rows: DataFrame) -> DataFrame:
    """(affiliation_id, raw_affiliation, source_file): cleaned raw affiliations, one a subject over all files."""
    from quillspark.functions.text import affiliation

    raw = rows.where(F.col("p").contains("affRawAffiliationString"))
    return raw.groupBy(F.col("s").alias("affiliation_id")).agg(F.min(F.struct("file_path", "o")).alias("first")).select("affiliation_id", F.col("first.o").alias("o"), F.col("first.file_path").alias("source_file")).select("affiliation_id", affiliation(F.col("o")).alias("raw_affiliation"), "source_file")
