"""Quality score from compression: zstandard dictionaries of good and of bad text.

A text is cut into blocks of ``block`` bytes and every block is compressed once with each dictionary, so the
dictionary bears on the whole text and not only on its start. The difference of the two total sizes over the raw
size is the one feature; a logistic fit on labelled text turns it into a probability.

Defined results: a null or empty text has the difference 0; null doc_id rows are scored and are not held out;
repeated rows are scored each. With no labels of one class every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import as_batch, batches, labelled_sample, logistic, sigmoid, text_bytes

PER_CLASS, MAX_BYTES = 2000, 16384


@dataclass
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float
    block: int = 1024
    level: int = 3

    def _compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=self.level)
            made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False, level=self.level))
        return made

    def difference(self, texts: list[bytes]) -> np.ndarray:
        """(size with the bad dictionary - size with the good one) / raw size, by text; 0 for an empty text."""
        if not self.good or not self.bad:
            return np.zeros(len(texts))
        good, bad = (c.compress for c in self._compressors())
        out = np.zeros(len(texts))
        for i, body in enumerate(texts):
            total = 0
            for at in range(0, len(body), self.block):
                piece = body[at : at + self.block]
                total += len(bad(piece)) - len(good(piece))
            out[i] = total / len(body) if body else 0.0
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        return sigmoid(self.slope * self.difference(texts) + self.intercept)


def _dictionary(texts: list[bytes], size: int, block: int, level: int) -> bytes:
    pieces = [t[at : at + block] for t in texts for at in range(0, len(t), block)]
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, pieces)) // 8)), pieces, level=level).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: the texts themselves are the dictionary
        return b"".join(pieces)[-size:]


def fit(sample: list[tuple[bytes, int]], dict_size: int = 65536, block: int = 1024, level: int = 3, prior: float | None = None) -> CompressionModel:
    """Dictionaries from three quarters of the sample, the calibration from the rest (each class split alike).

    ``prior`` is the share of label 1 to calibrate to; by default the sample's own.
    """
    by = {v: [t for t, y in sample if y == v] for v in (0, 1)}
    share = len(by[1]) / len(sample) if sample else 0.5
    if len(by[0]) < 4 or len(by[1]) < 4:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return CompressionModel(b"", b"", 0.0, float(np.log(share / (1 - share))), block, level)
    train = {v: [t for i, t in enumerate(by[v]) if i % 4] for v in by}
    held = [(t, v) for v in by for i, t in enumerate(by[v]) if i % 4 == 0]
    model = CompressionModel(_dictionary(train[1], dict_size, block, level), _dictionary(train[0], dict_size, block, level), 0.0, 0.0, block, level)
    x, y = model.difference([t for t, _ in held]), np.array([v for _, v in held], float)
    scale = max(float(np.abs(x).max()), 1e-9)
    w = logistic(x[:, None] / scale, y, ridge=1e-4)
    model.slope, model.intercept = float(w[0]) / scale, float(w[1])
    if prior is not None and 0 < prior < 1:
        model.intercept += float(np.log(prior / (1 - prior)) - np.log(y.mean() / (1 - y.mean())))
    return model


def fit_tables(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4, held_out: int = 2, per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> CompressionModel:
    """A model from at most ``per_class`` texts of each label, each at most ``max_bytes`` long (the bounds of the fit)."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus != held_out
    n, ones = labels.where(crc & F.col(label).isin(0, 1)).agg(F.count("*"), F.sum(F.col(label).cast("long"))).first()
    return fit(labelled_sample(docs, labels, label, modulus, held_out, per_class, max_bytes), prior=(ones / n) if n else None)


def score(docs: DataFrame, model: CompressionModel, modulus: int = 4, held_out: int = 2, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            s = shared.value.score(batch.column(1).to_pylist())
            yield as_batch({"doc_id": batch.column(0), "score": s, "predicted": (s >= threshold).astype(np.int32)})

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == held_out, F.lit(False))
    return text_bytes(docs, "doc_id").mapInArrow(run, "doc_id long, score double, predicted int").select("doc_id", held.alias("held_out"), "score", "predicted")
