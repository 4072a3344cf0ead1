"""Line deduplication by content-defined chunks of lines.

Lines end at newlines; blank lines belong to the line before. A line of ``LONG_WORDS`` words or more is a paragraph and
falls into sentences, each a line, but sentences of under ``SHORT_WORDS`` words belong to the one before. A sentence that
is as long falls into parts of about four words where a rolling hash over two words says so; a part is no line. Words
are parted by blanks of any kind; in scripts without blanks two characters are a word.

A run of lines counts if it has ``min_words`` words and two lines, or ``alone_words`` words. Boundaries are chosen by
content: a rolling hash over the hashes of two lines that follow each other chooses the line where it is less than at
one of its neighbours, so of any two lines running one is chosen at least, wherever they stand. A chunk is the shortest run
that counts from a chosen line on, newlines or not; lines of ``alone_words`` words are chunks by themselves.

Chunks found more than once in the corpus are grown line by line: near them, the shortest runs that count from and up
to every line are counted as well, so a repeated passage is found with the lines at its ends. Each run found more than
once is removed everywhere but at its first place (by doc_id, then place). Any repeated passage of 50 words or more
that begins and ends with whole lines goes wholly, but for its first place.

Hashes are counted first; they alone are shuffled, and each text's runs are made again from the text at the end. Bytes
decide: where a hash is found again, an aggregate keeps the least and the greatest bytes of it; if these differ, no run
of that hash is removed. It combines before the shuffle, so a passage that a third of all documents share is one row a
task. Texts are shuffled once, for the byte comparison and the removal alike.

Defined results: null and empty texts stay as they are; rows equal in doc_id and text are one document and keep the
same; null doc_ids sort first; ties of place fall to the text's hash; an empty table gives no rows. A document whose
every run is elsewhere stays with an empty text or what is left. Extra columns of any name are kept, but a column
``removed_chunks`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType

from quillspark.llm.common import as_batch, batches, checkpointed
from quillspark.llm.rolling import Rolling, chain, mix

MIN_WORDS, ALONE_WORDS = 8, 20
#: From how many words on a line is cut into sentences, and these into parts; under how many words a sentence is none;
#: of about how many words a part is.
LONG_WORDS, SHORT_WORDS, PART = 50, 4, 4
#: How many runs (two a line at most) beside a repeated chunk are counted as well.
NEAR = 8
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\v\f"))
_MARK, _QUOTE, _GAP = (np.isin(np.arange(256), list(x)) for x in (b".!?", b"\"')]", b" \t"))
#: Sentence marks beyond ASCII: before blanks, and those of scripts without blanks.
_WIDE_MARK = re.compile("(?:…|؟|۔|।)[\"')\\]]*[ \t]+|。|！|？|｡".encode())
#: A character of a script without blanks, in UTF-8: Thai, Lao, Burmese, Khmer, kana and Han.
_DENSE = re.compile(rb"\xe0[\xb8-\xbb].|\xe1[\x80-\x82\x9e\x9f].|\xe3[\x81-\xbf].|[\xe4-\xe9]..|\xf0[\xa0-\xbf]..", re.S)


@dataclass
class Runs:
    """Runs of lines of several texts, by text and place: bytes from ``start`` to ``stop``, the next line at ``next``."""

    text: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    next: np.ndarray
    hash: np.ndarray
    chosen: np.ndarray


def _sentence_ends(data: np.ndarray, joined: bytes) -> np.ndarray:
    """Where sentences end: after their marks with the blanks that follow."""
    end = np.flatnonzero(_MARK[data]) + 1
    for where in (_QUOTE, _GAP):
        if where is _GAP:
            end = end[_GAP[data[end]]]
        go = np.flatnonzero(where[data[end]])
        while len(go):  # a newline closes the array, and is neither
            end[go] += 1
            go = go[where[data[end[go]]]]
    return np.unique(np.concatenate([end, np.array([m.end() for m in _WIDE_MARK.finditer(joined)], np.int64)])) if data.max() >= 0xD8 else np.unique(end)


def _line_ends(data: np.ndarray, joined: bytes, word: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Where lines end, sorted: at newlines, and in long ones after sentences."""
    line = np.flatnonzero(data == 10) + 1
    size = np.diff(total[np.searchsorted(word, line)], prepend=0)
    inner = _sentence_ends(data, joined)
    inner = inner[size[np.searchsorted(line, inner)] >= 2 * LONG_WORDS]
    both = np.union1d(line, inner)
    follow = np.diff(total[np.searchsorted(word, both)], append=total[-1])  # words of the sentence after each end
    return both[(data[both - 1] == 10) | (follow >= 2 * SHORT_WORDS)]


def _words(data: np.ndarray, joined: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of words, and twice the words each counts as (a dense character is half a word)."""
    blank = _SPACE[data]
    before = np.concatenate([[True], blank[:-1]])
    dense = np.array([m.start() for m in _DENSE.finditer(joined)], np.int64) if data.max() >= 0xE0 else np.zeros(0, np.int64)
    if not len(dense):
        start = np.flatnonzero(before & ~blank)
        return start, np.flatnonzero(blank & ~before), np.full(len(start), 2)
    inside = np.zeros(len(data), bool)
    size = np.where(data[dense] >= 0xF0, 4, 3)
    for k in range(4):
        inside[dense[size > k] + k] = True
    after = np.concatenate([[False], inside[:-1]])
    single = np.zeros(len(data), bool)
    single[dense] = True
    start = np.flatnonzero(single | (~blank & ~inside & (before | after)))
    ends = np.flatnonzero((blank & ~before) | (inside & ~after & ~before) | (after & ~inside & ~blank))
    stop = np.append(start[1:], len(data))
    ends = np.append(ends, len(data))
    return start, np.minimum(stop, ends[np.searchsorted(ends, start, side="right")]), np.where(single[start], 1, 2)


def runs(bodies: list[bytes], min_words: int = MIN_WORDS, alone_words: int = ALONE_WORDS) -> Runs:
    """The shortest runs that count from and up to every line of every text; ``chosen`` are the content-defined chunks."""
    joined = b"\n".join(bodies) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    bounds = np.concatenate([[0], np.cumsum(np.array([len(b) + 1 for b in bodies], np.int64))])
    rolling = Rolling(data)
    word, word_stop, weight = _words(data, joined)
    total = np.concatenate([[0], np.cumsum(weight)])
    end = _line_ends(data, joined, word, total)
    begin = np.concatenate([[0], end[:-1]])
    first, last = np.searchsorted(word, begin), np.searchsorted(word, end)
    full = last > first
    begin, first, last = begin[full], first[full], last[full]
    whole = np.ones(len(begin), bool)
    long = total[last] - total[first] >= 2 * LONG_WORDS
    if long.any():
        of = np.repeat(np.flatnonzero(long), (last - first)[long])
        index = np.concatenate([np.arange(a, b) for a, b in zip(first[long].tolist(), last[long].tolist())])
        pair = chain(rolling.hash(word[index], word_stop[index]), 2)
        cut = np.flatnonzero((pair % np.uint64(PART) == 0)[:-1] & (of[2:] == of[:-2])) + 2 if len(index) > 2 else np.zeros(0, np.int64)
        begin, first = np.append(begin, word[index[cut]]), np.append(first, index[cut])
        order = np.argsort(first, kind="stable")
        whole = np.append(~long, np.zeros(len(cut), bool))[order]
        begin, first = begin[order], first[order]
        last = np.append(first[1:], len(word)) if len(first) else first
    n = len(begin)
    text = np.searchsorted(bounds, begin, side="right") - 1
    stop = word_stop[last - 1]
    words = np.append(total[first], total[-1])
    lines = np.concatenate([[0], np.cumsum(whole)])
    low, high = np.searchsorted(text, text), np.searchsorted(text, text, side="right")
    at = np.arange(n)
    short, alone = 2 * min_words, 2 * alone_words
    # a text's words end where its lines end: sums over lines are differences of ``words``
    to = np.minimum(np.searchsorted(words, words[:-1] + alone), np.maximum(np.searchsorted(words, words[:-1] + short), np.searchsorted(lines, lines[:-1] + 2)))
    back = np.maximum(np.searchsorted(words, words[1:] - alone, side="right"), np.minimum(np.searchsorted(words, words[1:] - short, side="right"), np.searchsorted(lines, lines[1:] - 2, side="right"))) - 1
    ahead, behind = to <= high, back >= low
    pairs = np.unique(np.concatenate([at[ahead] * (n + 1) + to[ahead], back[behind] * (n + 1) + at[behind] + 1]))
    i, j = pairs // (n + 1), pairs % (n + 1)
    # rolling hash over the hashes of two lines running, chosen where it is less than at a neighbour
    line = rolling.hash(begin, stop)
    two = np.full(n + 2, np.iinfo(np.uint64).max, np.uint64)
    if n > 1:
        two[1:n] = np.where(text[1:] == text[:-1], chain(line, 2), two[0])
    boundary = (two[1:-1] < two[:-2]) | (two[1:-1] < two[2:]) | (words[1:] - words[:-1] >= alone)
    shift = bounds[text[i]]
    after = np.where(j < high[i], np.append(begin, 0)[j], bounds[text[i] + 1] - 1)
    return Runs(text[i], begin[i] - shift, stop[j - 1] - shift, after - shift, rolling.hash(begin[i], stop[j - 1]), boundary[i] & (to[i] == j))


def chunks(body: bytes, min_words: int = MIN_WORDS, alone_words: int = ALONE_WORDS) -> list[tuple[int, int, int]]:
    """(start, stop, next) of the content-defined chunks of one text, blanks at their ends left off."""
    r = runs([body], min_words, alone_words)
    return list(zip(r.start[r.chosen].tolist(), r.stop[r.chosen].tolist(), r.next[r.chosen].tolist()))


def cut(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``body`` without the given spans (start, next); what a removal leaves at the end loses its trailing blanks."""
    kept, at = [], 0
    for a, b in sorted(spans):
        kept.append(body[at:a])  # nothing if the spans overlap
        at = max(at, b)
    kept.append(body[at:])
    joined = b"".join(kept)
    return joined.rstrip() if at == len(body) else joined


def apart(spans: list[tuple[int, int]]) -> int:
    """How many passages the spans (start, next) make."""
    n, at = 0, -1
    for a, b in sorted(spans):
        n += a > at
        at = max(at, b)
    return n


def sketches(docs: DataFrame) -> DataFrame:
    """By document: doc_id, tkey and the hashes of its runs in order, the last bit set for content-defined chunks."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, most=1_000_000):
            r = runs(batch.column(2).to_pylist())
            ends = np.searchsorted(r.text, np.arange(batch.num_rows + 1))
            h = (r.hash & ~np.uint64(1) | r.chosen.astype(np.uint64)).view(np.int64)
            made = as_batch({"doc_id": batch.column(0), "tkey": batch.column(1), "h": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(h))})
            yield made.filter(pa.array(np.diff(ends) > 0))

    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    keyed = docs.select("doc_id", F.xxhash64(body).alias("tkey"), body.alias("body"))
    return keyed.mapInArrow(run, "doc_id long, tkey long, h array<long>")


def _grown(found: DataFrame) -> DataFrame:
    """The hashes (last bit cleared) of the runs within NEAR of a chunk in ``hit``, by document."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            kept = []
            for hashes, hit in zip(batch.column(2), batch.column(3)):
                h = hashes.values.to_numpy()
                at = np.flatnonzero(np.isin(h, hit.values.to_numpy()))
                near = np.zeros(len(h) + 1, np.int64)
                np.add.at(near, np.maximum(at - NEAR, 0), 1)
                np.add.at(near, np.minimum(at + NEAR + 1, len(h)), -1)
                kept.append(h[np.cumsum(near[:-1]) > 0] & ~1)
            if kept:
                ends = np.concatenate([[0], np.cumsum([len(k) for k in kept])])
                yield as_batch({"doc_id": batch.column(0), "tkey": batch.column(1), "h": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(kept)))})

    return found.select("doc_id", "tkey", "h", "hit").mapInArrow(run, "doc_id long, tkey long, h array<long>")


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, tkey, kept, gone): by document, the hashes of the runs found more than once, ``kept`` where it is their first place."""
    sketch = checkpointed(sketches(docs).withColumn("row", F.monotonically_increasing_id()))
    seeds = sketch.select("row", F.explode("h").alias("h")).where(F.col("h") % 2 != 0)
    again = seeds.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    hits = seeds.join(again, "h", "left_semi").groupBy("row").agg(F.collect_list("h").alias("hit"))
    near = checkpointed(_grown(sketch.join(hits, "row")))
    each = near.select("doc_id", "tkey", F.explode("h").alias("h"))
    counted = each.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "tkey")).alias("first")).where("n > 1").select("h", "first")
    met = each.join(counted, "h").select("doc_id", "tkey", "h", F.struct("doc_id", "tkey").eqNullSafe(F.col("first")).alias("own"))
    return checkpointed(met.groupBy("doc_id", "tkey").agg(F.collect_set(F.when(F.col("own"), F.col("h"))).alias("kept"), F.collect_set(F.when(~F.col("own"), F.col("h"))).alias("gone")))


def cover(start: list[int], stop: list[int]) -> list[int]:
    """Numbers of as few of the given stretches as cover what all cover, from the least start on."""
    order = sorted(range(len(start)), key=lambda k: start[k])
    chosen, end, at = [], -1, 0
    while at < len(order):
        reach, best = max(end, start[order[at]]), order[at]
        while at < len(order) and start[order[at]] <= reach:
            best = max(best, order[at], key=lambda k: stop[k])
            at += 1
        if stop[best] > end:
            chosen.append(best)
            end = stop[best]
    return chosen


@dataclass
class Found:
    """The runs of a batch of texts that are in the corpus more than once."""

    runs: Runs
    #: Numbers of these runs at their first place, and of a few others that cover all that aren't.
    first: np.ndarray
    later: np.ndarray


def find(bodies: list[bytes], kept: list[list[int] | None], gone: list[list[int] | None]) -> Found:
    r = runs(bodies)
    h = (r.hash & ~np.uint64(1)).view(np.int64)
    ends = np.searchsorted(r.text, np.arange(len(bodies) + 1))
    firsts, later = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k, (stay, go) in enumerate(zip(kept, gone)):
        if stay or go:
            mine = h[ends[k] : ends[k + 1]]
            here = np.flatnonzero(np.isin(mine, np.array(stay, np.int64)))
            _, first = np.unique(mine[here], return_index=True)
            away = np.concatenate([np.delete(here, first), np.flatnonzero(np.isin(mine, np.array(go, np.int64)))]) + ends[k]
            firsts.append(here[first] + ends[k])
            later.append(away[cover(r.start[away].tolist(), r.next[away].tolist())])
    return Found(r, np.concatenate(firsts), np.concatenate(later))


def _packer(pack: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs or unpacks the column ``body`` of batches, nulls aside; slices hold about a megabyte."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = zstandard.ZstdCompressor(level=1).compress if pack else zstandard.ZstdDecompressor().decompress
        for batch in batches(source, most=1_000_000 if pack else 300_000):
            at = batch.schema.get_field_index("body")
            made = pa.array([None if b is None else turn(b) if b else b for b in batch.column(at).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([made if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return run


def dedup(docs: DataFrame) -> DataFrame:
    """Every row of ``docs``, all columns kept, its text without repeated runs, and removed_chunks (runs that touch count once).

    n_chars, where there is such a column, is that of the new text if runs were removed.
    """
    names = [n for n in docs.columns if n != "removed_chunks"]
    rest = [n for n in names if n != "text"]
    quoted = {n: F.col("`" + n.replace("`", "``") + "`") for n in names}
    own = docs.select(quoted["doc_id"].alias("doc"), F.xxhash64(F.coalesce(quoted["text"].cast("binary"), F.lit(b""))).alias("key"), quoted["text"].cast("binary").alias("body"), F.struct(*[quoted[n].alias(n) for n in rest]).alias("rest"))
    # texts are shuffled packed
    own = own.mapInArrow(_packer(pack=True), own.schema)
    spans = repeated(docs).withColumnsRenamed({"doc_id": "of_doc", "tkey": "of_key"})
    on = own["doc"].eqNullSafe(spans["of_doc"]) & (own["key"] == spans["of_key"])

    def pieces(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _packer(pack=False)(source):
            bodies = batch.column(0).to_pylist()
            f = find(bodies, batch.column(2).to_pylist(), batch.column(3).to_pylist())
            at = np.concatenate([f.first, f.later])
            found = {(h, bodies[t][a:b]) for h, t, a, b in zip((f.runs.hash[at] & ~np.uint64(1)).view(np.int64).tolist(), f.runs.text[at].tolist(), f.runs.start[at].tolist(), f.runs.stop[at].tolist())}
            yield as_batch({"h": pa.array([h for h, _ in found], pa.int64()), "piece": pa.array([p for _, p in found], pa.binary())})

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _packer(pack=False)(source):
            made, removed = batch.column(0).to_pylist(), [0] * batch.num_rows
            unlike = [set(u or ()) for u in batch.column(4).to_pylist()]
            f = find([b or b"" for b in made], *(batch.column(i).to_pylist() for i in (2, 3)))
            spans: dict[int, list] = {}
            for h, t, a, b in zip((f.runs.hash[f.later] & ~np.uint64(1)).view(np.int64).tolist(), f.runs.text[f.later].tolist(), f.runs.start[f.later].tolist(), f.runs.next[f.later].tolist()):
                if h not in unlike[t]:
                    spans.setdefault(t, []).append((a, b))
            for t, gone in spans.items():
                made[t], removed[t] = cut(made[t], gone), apart(gone)
            yield as_batch({"body": pa.array(made, pa.binary()), "removed": pa.array(removed, pa.int32()), "rest": batch.column(1)})

    # the same columns of the texts go through both joins, so that their shuffle is written once
    compared = own.join(spans, on).select("body", "rest", "kept", "gone").mapInArrow(pieces, "h long, piece binary")
    unlike = compared.groupBy("h").agg(F.min("piece").alias("low"), F.max("piece").alias("high")).where("low <> high").select("h")
    wrong = spans.select("of_doc", "of_key", F.explode("gone").alias("h")).join(unlike, "h").groupBy("of_doc", "of_key").agg(F.collect_set("h").alias("unlike"))
    marked = spans.join(wrong.withColumnsRenamed({"of_doc": "u_doc", "of_key": "u_key"}), F.col("of_doc").eqNullSafe(F.col("u_doc")) & (F.col("of_key") == F.col("u_key")), "left").drop("u_doc", "u_key")
    joined = own.join(marked, on, "left").select("body", "rest", "kept", "gone", "unlike")
    schema = StructType([StructField("body", BinaryType()), StructField("removed", IntegerType()), StructField("rest", own.schema["rest"].dataType)])
    text, kept = F.col("body").cast("string"), {n: F.col("rest.`" + n.replace("`", "``") + "`") for n in rest}
    if "n_chars" in kept:
        kept["n_chars"] = F.when(F.col("removed") > 0, F.length(text)).otherwise(kept["n_chars"]).cast("long")
    return joined.mapInArrow(run, schema).select(*[(text if n == "text" else kept[n]).alias(n) for n in names], F.col("removed").alias("removed_chunks"))
