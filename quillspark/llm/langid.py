"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of one to three code points of lower-cased text in ``buckets`` hashed bins by language; the
matrix of log-probabilities is broadcast (languages x orders x buckets floats, independent of the corpus) and whole
texts are scored in batches: every n-gram's row is gathered, and the sums by document are the log-likelihoods.

The fit takes a bounded sample: about ``most_rows`` labelled texts, shared equally by the languages, chosen by the hash of
doc_id among the rows that may be learnt from, of each the first ``max_chars`` characters. Scoring has no such limits.

Defined results: a null text or one without any letter is ``und`` with score 0; null lang rows are not learnt from
but predicted; without any labelled text everything is ``und``; repeated rows are scored each; of languages with equal
scores the first by code point wins; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import as_batch, batches, hashed_share, share_of

ORDERS, BUCKETS = (1, 2, 3), 1 << 14
#: As how many independent n-grams an endless text counts.
INDEPENDENT = 50
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_LETTER = re.compile(r"[^\W\d_]")


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Start and length of each text in one array of code points, and by order the bin of the n-gram that begins at each place.

    Zeros end the last n-grams of every text, and no n-gram reaches the next: places after a text have the bin BUCKETS.
    """
    low = [t.lower() for t in texts]
    gap = max(ORDERS) - 1
    points = np.frombuffer(("\0" * gap).join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in low], np.int64)
    starts = np.cumsum(lengths + gap) - lengths - gap
    outside = np.ones(len(points), bool)
    outside[np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())] = False
    bins, value = [], np.zeros(len(points), np.uint32)
    for order in ORDERS:
        ahead = np.zeros(len(points), np.uint32)
        ahead[: len(points) - order + 1] = points[order - 1 :]
        value = value * np.uint32(31) + ahead * _MULTIPLIERS[order - 1]
        mixed = value * np.uint32(0x9E3779B1)
        found = (mixed >> np.uint32(18)).astype(np.int32)
        found[outside] = BUCKETS
        bins.append(found)
    return starts, lengths, bins


@dataclass
class LanguageModel:
    languages: list[str]
    #: [order, language, bin] log-probabilities; the last bin, of no n-gram, is 0.
    table: np.ndarray
    prior: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        out, score = ["und"] * len(texts), np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        if not known:
            return out, score
        starts, lengths, bins = grams([texts[i] for i in known])
        total = np.zeros((len(known), len(self.languages)))
        for order, places in enumerate(bins):
            for j in range(len(self.languages)):
                total[:, j] += np.add.reduceat(self.table[order, j][places], starts, dtype=np.float64)
        # neighbouring n-grams overlap: a text counts as fewer independent ones, at most INDEPENDENT
        mean = total / lengths[:, None] * (lengths * INDEPENDENT / (lengths + INDEPENDENT))[:, None] + self.prior
        order = np.sort(mean, axis=1)
        best = mean.argmax(axis=1)
        sure = 1 / np.exp(mean - order[:, -1:]).sum(axis=1)
        for i, b, s in zip(known, best.tolist(), sure.tolist()):
            out[i], score[i] = self.languages[b], s
        return out, score


def fit(rows: list[tuple[str, str]], smoothing: float = 0.5, shares: dict[str, int] | None = None) -> LanguageModel:
    """The model of (text, lang) rows; ``shares`` are the languages' counts for the prior, if not those of the rows."""
    languages = sorted({lang for _, lang in rows})
    index = {x: i for i, x in enumerate(languages)}
    counts = np.zeros((len(ORDERS), len(languages), BUCKETS + 1))
    n = np.zeros(len(languages))
    for text, lang in rows:
        n[index[lang]] += 1
        for order, places in enumerate(grams([text])[2]):
            counts[order, index[lang]] += np.bincount(places, minlength=BUCKETS + 1)
    counts += smoothing
    counts[:, :, BUCKETS] = 0
    table = np.log(counts / counts.sum(axis=2, keepdims=True), where=counts > 0, out=np.zeros_like(counts)).astype(np.float32) if rows else counts.astype(np.float32)
    if shares is not None:
        n = np.array([shares[x] for x in languages], float)
    return LanguageModel(languages, table, np.log((n + 1) / (n + 1).sum()) if rows else n)


def fit_table(docs: DataFrame, modulus: int = 5, held_out: int = 0, most_rows: int = 4000, max_chars: int = 8192) -> LanguageModel:
    usable = docs.select("doc_id", "lang", F.substring("text", 1, max_chars).alias("text")).where((F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus != held_out) & F.col("lang").isNotNull() & (F.length("text") > 0))
    n = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # a row a language, as in the model
    if not n:
        return fit([])
    each = max(1, most_rows // len(n))
    shares = docs.sparkSession.createDataFrame([(lang, share_of(each, c)) for lang, c in n.items()], "lang string, share double")
    # a number a language, checked: a broadcast keeps texts from being shuffled by language
    shares = F.broadcast(shares) if len(n) <= 100_000 else shares
    place = hashed_share("lang", "doc_id")
    picked = usable.join(shares, "lang").where(place < F.col("share")).groupBy("doc_id", "lang", place.alias("place")).agg(F.min("text").alias("text"))
    by: dict[str, list] = {}
    for r in picked.collect():
        by.setdefault(r["lang"], []).append((r["place"], r["doc_id"], r["text"]))
    return fit(sorted((text, lang) for lang, rows in by.items() for _, _, text in sorted(rows)[:each]), shares=n)


def predict(docs: DataFrame, model: LanguageModel, modulus: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, "text", 500_000):
            langs, score = shared.value.predict(batch.column(1).to_pylist())
            yield as_batch({"doc_id": batch.column(0), "lang_pred": pa.array(langs, pa.string()), "score": score})

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == held_out, F.lit(False))
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double").select("doc_id", held.alias("held_out"), "lang_pred", "score")
