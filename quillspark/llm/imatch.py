"""I-Match fingerprints with randomised lexicons.

A document's terms are its distinct lower-cased words without outer marks. The lexicon keeps terms inside a band of
inverse document frequency, counted over all documents; each randomised lexicon keeps a fixed pseudo-random share of
it. A fingerprint is, by lexicon, the hash of the document's sorted distinct terms in it (zero if there is none).

The lexicon is a bit set of 2^22 hashed terms, half a megabyte whatever the corpus. Hashing adds at most about
(distinct terms a document) / 2^22 of all documents to a term's frequency, far below the band, at any size. The terms
inside the band are at most (distinct terms a document) / ``least_share``, so collecting them is bounded too.

Defined results: a null or empty text has a fingerprint of zeros; two such are alike (1.0). Documents with equal ids
follow each other by the hash of their text; null ids come first. A table's only document follows itself.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import as_batch, batches, hashed_share, share_of, task_partitions, text_bytes, tokens

BITS = 22
#: Text bytes a range of documents, and sampled keys a range.
RANGE_BYTES, PER_RANGE = 128 << 20, 200
#: The share of the lexicon that each randomised lexicon keeps.
RATES = (4,) * 4 + (16,) * 4 + (64,) * 8 + (256,) * 8
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_SALTS = np.array([xxhash.xxh64_intdigest(b"lexicon %d" % i) | 1 for i in range(len(RATES))], np.uint64)


def term_hashes(words: list[str]) -> np.ndarray:
    """64-bit hash of each word without its outer marks; 0 if nothing is left."""
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w if w.isalpha() else x) if w.isalpha() or (x := _EDGE.sub("", w)) else 0 for w in words], np.uint64)


def _terms(body: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, term hash) of the distinct terms of each text, sorted."""
    rows, codes, words, _ = tokens(body)
    if not len(rows):
        return rows, np.zeros(0, np.uint64)
    hashes, back = np.unique(term_hashes(words), return_inverse=True)
    key = np.unique(rows * len(hashes) + back[codes])
    rows, terms = key // len(hashes), hashes[key % len(hashes)]
    kept = terms != 0
    return rows[kept], terms[kept]


def _bucket(terms: np.ndarray) -> np.ndarray:
    return (terms >> np.uint64(64 - BITS)).astype(np.int64)


class Lexicon:
    def __init__(self, buckets: np.ndarray) -> None:
        self.bits = np.zeros(1 << BITS, bool)
        self.bits[buckets] = True

    def __getstate__(self) -> bytes:
        return np.packbits(self.bits).tobytes()

    def __setstate__(self, state: bytes) -> None:
        self.bits = np.unpackbits(np.frombuffer(state, np.uint8)).astype(bool)

    def fingerprints(self, body: pa.Array) -> np.ndarray:
        """[texts, lexicons] of 32-bit hashes, 0 where a lexicon has none of the text's terms."""
        rows, terms = _terms(body)
        kept = self.bits[_bucket(terms)]
        rows, terms = rows[kept], terms[kept]
        out = np.zeros((len(body), len(RATES)), np.uint32)
        digest = xxhash.xxh32_intdigest
        for k, rate in enumerate(RATES):
            mixed = (terms ^ (terms >> np.uint64(31))) * _SALTS[k]
            chosen = np.flatnonzero((mixed >> np.uint64(40)) % np.uint64(rate) == 0)
            data, owner = terms[chosen].tobytes(), rows[chosen]
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            ends = np.append(starts[1:], len(owner))
            for row, a, b in zip(owner[starts].tolist(), starts.tolist(), ends.tolist()):
                out[row, k] = digest(data[8 * a : 8 * b]) or 1
        return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By row, the share of lexicons with terms of either in which both hashes agree; 1 if there is no such lexicon."""
    some = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    return np.where(some == 0, 1.0, same / np.maximum(some, 1))


def fit_lexicon(docs: DataFrame, least_share: float = 0.0005, most_share: float = 0.2, least: int = 2) -> Lexicon:
    """The terms in at least ``least`` documents and ``least_share`` of all, and in at most ``most_share`` of all."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(1 << BITS, np.int32), 0
        for batch in batches(source):
            n += batch.num_rows
            rows, terms = _terms(batch.column(0))
            key = np.unique(rows << BITS | _bucket(terms)) & ((1 << BITS) - 1)
            np.add.at(counts, key, 1)
        found = np.flatnonzero(counts)
        for at in range(0, len(found), 100_000):
            part = found[at : at + 100_000]
            yield as_batch({"bucket": part.astype(np.int32), "n": counts[part].astype(np.int64)})
        yield as_batch({"bucket": np.array([-1], np.int32), "n": np.array([n], np.int64)})

    counts = text_bytes(docs).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = docs.count()
    low, high = max(least, math.ceil(least_share * total)), math.floor(most_share * total)
    band = counts.where((F.col("bucket") >= 0) & F.col("n").between(low, high)).select("bucket").toArrow()
    return Lexicon(band.column("bucket").to_numpy().astype(np.int64))


def _ordered(docs: DataFrame, parts: int | None) -> DataFrame:
    """Rows by ranges of (doc_id, hash of the text), sorted, each range followed by the first rows of the next.

    Columns: part, halo, doc_id, tie, packed. Ranges hold about ``RANGE_BYTES`` bytes, whatever the size of the table,
    and part the rows of one id (or of none) too. Bounds come from a sample of ``PER_RANGE`` keys a range; only it and
    each range's least key come to the driver.
    """
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    ids = docs.select("doc_id", F.xxhash64(body).alias("tie"), F.length(body).alias("n"))
    rows, size = ids.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = parts or max(task_partitions(docs.sparkSession), -(-size // RANGE_BYTES))
    some = ids.where(hashed_share("range", "doc_id", "tie") < share_of(parts * PER_RANGE, rows)).select("doc_id", "tie")
    keys = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["tie"]) for r in some.collect())
    splits = sorted({keys[len(keys) * i // parts] for i in range(1, parts)} if keys else set())

    def keys_of(ids: pa.Array, ties: pa.Array) -> list[tuple]:
        return [(i is not None, i or 0, t) for i, t in zip(ids.to_pylist(), ties.to_pylist())]

    def place(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple] = {}
        for batch in source:
            for key in keys_of(batch.column(0), batch.column(1)):
                p = bisect_right(splits, key)
                if p not in least or key < least[p]:
                    least[p] = key
        if least:
            yield as_batch({"part": pa.array(list(least), pa.int32()), "some": pa.array([k[0] for k in least.values()]), "id": pa.array([k[1] for k in least.values()], pa.int64()), "tie": pa.array([k[2] for k in least.values()], pa.int64())})

    firsts = {r["part"]: tuple(r["key"]) for r in ids.mapInArrow(place, "part int, some boolean, id long, tie long").groupBy("part").agg(F.min(F.struct("some", "id", "tie")).alias("key")).collect()}
    filled = sorted(firsts)
    before = {firsts[p]: filled[i - 1] for i, p in enumerate(filled)}

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches(source):
            values, keys = batch.column(0), keys_of(batch.column(0), batch.column(1))
            part = [bisect_right(splits, k) for k in keys]
            packed = [pack(t) for t in batch.column(2).to_pylist()]
            copies = [(i, before[k]) for i, k in enumerate(keys) if k in before]
            index = pa.array([*range(len(part)), *(i for i, _ in copies)], pa.int64())
            yield as_batch({"part": pa.array([*part, *(p for _, p in copies)], pa.int32()), "halo": pa.array([False] * len(part) + [True] * len(copies)), "doc_id": values.take(index), "tie": batch.column(1).take(index), "packed": pa.array(packed, pa.binary()).take(index)})

    rows = docs.select("doc_id", F.xxhash64(body).alias("tie"), body.alias("body")).mapInArrow(run, "part int, halo boolean, doc_id long, tie long, packed binary")
    return rows.repartitionById(len(splits) + 1, F.col("part")).sortWithinPartitions("part", "halo", F.col("doc_id").asc_nulls_first(), "tie")


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first code points of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare(docs: DataFrame, lexicon: Lexicon, parts: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    columns = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

    def emit(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Rows of all texts but the last, which only follows."""
        lexicon = shared.value
        made = [edited(a, b) for a, b in zip(texts, texts[1:])]
        prints = lexicon.fingerprints(pa.array(texts, pa.string()))
        after = lexicon.fingerprints(pa.array(made, pa.string()))
        own = prints[:-1]
        hexed = [[row.tobytes().hex() for row in x.astype(">u4")] for x in (own, after)]
        return as_batch(dict(zip(columns, (pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in made], pa.string()), pa.array(hexed[0], pa.string()), pa.array(hexed[1], pa.string()), likeness(own, after), likeness(own, prints[1:])))))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        ids: list = []
        texts: list[str] = []
        size, ended = 0, False
        for batch in source:
            for halo, doc, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(4).to_pylist()):
                if halo and ended:
                    continue
                text = unpack(packed).decode("utf-8", "replace") if packed else ""
                texts.append(text)
                size += len(text)
                if halo:
                    if ids:
                        yield emit(ids, texts)
                    ids, texts, size, ended = [], [], 0, True
                    continue
                ended = False
                if size > 1_000_000 and ids:
                    yield emit(ids, texts)
                    ids, texts, size = [], [text], len(text)
                ids.append(doc)

    return _ordered(docs, parts).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
