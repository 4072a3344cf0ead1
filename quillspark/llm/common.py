"""Helpers the operators share: table access, checkpoints, labelled samples and Arrow batches."""

from __future__ import annotations

import ctypes
import os
import re
import sys
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The whitespace of the word contracts: space and \t\n\v\f\r.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut.

    The folder is that of ``shared_folder``.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share: the cluster's ``spark.checkpoint.dir``.

    Where that is unset, one of this machine is made if the session runs on this machine alone (tests); on a cluster
    that would lose data, so it raises.
    """
    conf = spark.sparkContext.getConf()
    shared = conf.get("spark.checkpoint.dir")
    if shared:
        return shared
    if not re.match(r"local(\[|$)", conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    return tempfile.mkdtemp(prefix="quillspark-checkpoint-")


def text_bytes(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the text as UTF-8 bytes, a null text empty: only these columns are read."""
    return docs.select(*columns, F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"))


def hashed_share(seed: str, *columns: str) -> Column:
    """A number from 0 to 1 that the columns' values fix: rows under a share are a sample of that share."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / float(1 << 30)


def share_of(wanted: int, there: int) -> float:
    """The share to draw so that the sample has about ``wanted`` rows; what is drawn never grows with the table."""
    return min(1.0, wanted / max(there, 1)) if there > wanted else 2.0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, per_class: int, max_bytes: int) -> list[tuple[bytes, int]]:
    """At most ``per_class`` labelled texts of each class (0 and 1) for fitting, chosen by the hash of doc_id.

    Rows with crc32(doc_id as text) mod ``modulus`` equal to ``held_out`` are never taken, nor are null labels,
    empty texts and texts over ``max_bytes`` (scoring has no such limits). The result is at most
    2 x per_class x max_bytes bytes however large the tables are.
    """
    ids = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus != held_out))
    n = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    place = hashed_share(label, "doc_id")
    some = sum((F.when(F.col("label") == v, share_of(per_class, c)).otherwise(0.0) for v, c in n.items()), F.lit(0.0))
    by: dict[int, dict[int, float]] = {0: {}, 1: {}}
    for r in ids.where(place < some).select("doc_id", "label", place.alias("place")).distinct().collect():
        by[r["label"]][r["doc_id"]] = r["place"]
    rows = [(d, v) for v, found in by.items() for d, _ in sorted(found.items(), key=lambda x: (x[1], x[0]))[:per_class]]
    if not rows:
        return []
    picked = docs.sparkSession.createDataFrame(rows, "doc_id long, label int")
    size = F.octet_length("text")
    texts = docs.select("doc_id", "text").where(size.between(1, max_bytes)).join(F.broadcast(picked), "doc_id")
    # repeated rows of an id bring one text each at most: the least, so that a rerun fits the same
    each = texts.groupBy("doc_id", "label").agg(F.min(F.col("text").cast("binary")).alias("body"))
    return sorted((bytes(r["body"]), r["label"]) for r in each.collect())


def batches(source: Iterator[pa.RecordBatch], column: str = "body", most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of the incoming batches with about ``most`` bytes in ``column`` (a single longer row stays whole)."""
    for batch in source:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64))
        start = 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, end - start)
            start = end
    give_back()


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on from task to task, side by side with the JVM."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def as_batch(arrays: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in arrays.values()], names=list(arrays))


def tokens(body: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str], list[int]]:
    """Lower-cased whitespace-separated tokens of a batch of UTF-8 texts.

    Returns (row of each token, code of each token, the distinct tokens by code, tokens per row).
    """
    text = body.cast(pa.string()) if not pa.types.is_string(body.type) else body
    lists = pc.utf8_split_whitespace(pc.utf8_lower(text))
    flat = pc.list_flatten(lists)
    rows = np.asarray(pc.list_parent_indices(lists), dtype=np.int64)
    if not len(flat):
        return rows, np.zeros(0, np.int64), [], np.zeros(len(body), np.int64)
    encoded = flat.dictionary_encode()
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    codes, words = np.asarray(encoded.indices, dtype=np.int64), encoded.dictionary.to_pylist()
    if "" in words:
        keep = codes != words.index("")
        rows, codes = rows[keep], codes[keep]
    return rows, codes, words, np.bincount(rows, minlength=len(body))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights (last: intercept) of a ridge logistic regression by Newton's method; ``x`` is [n, d]."""
    x = np.hstack([np.asarray(x, float), np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def sparse_logistic(lists: list[list[int]], d: int, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 100) -> np.ndarray:
    """The same for rows given as lists of the columns that are 1 (the last column, the intercept, in each), row i counting
    ``weight[i]`` times. Newton steps are found by conjugate gradients, so nothing of d x d or n x d numbers is made."""
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    cols = np.array([c for x in lists for c in x], np.int64)
    w, penalty = np.zeros(d), np.full(d, ridge)
    penalty[-1] = 1e-6
    forward = lambda v: np.bincount(rows, weights=v[cols], minlength=len(lists))
    back = lambda u: np.bincount(cols, weights=u[rows], minlength=d)
    for _ in range(steps):
        p = sigmoid(forward(w))
        grad = back(weight * (p - y)) + penalty * w
        curve = weight * (p * (1 - p) + 1e-9)
        scale = 1 / (back(curve) + penalty)  # the diagonal, to precondition
        step, rest = np.zeros(d), grad.copy()
        z = scale * rest
        way, size = z.copy(), rest @ z
        for _ in range(200):
            if size < 1e-18:
                break
            bent = back(curve * forward(way)) + penalty * way
            length = size / (way @ bent)
            step += length * way
            rest -= length * bent
            z = scale * rest
            size, before = rest @ z, size
            way = z + size / before * way
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def task_partitions(spark: SparkSession, default: int = 8) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", str(os.cpu_count() or default)))
