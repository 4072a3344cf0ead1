"""Packing token pieces into sequences by the sum-of-squares rule.

A document is its token ids and an end id. Documents over ``capacity`` ids are cut into full pieces, the first of which
may be shorter; full pieces are sequences of their own. The other pieces are packed: each goes where the sum over gaps
of the squared number of open sequences with that gap becomes smallest, a new one being opened only where none fits.
Longest pieces come first; ties prefer the fuller sequence.

Token ids never leave the task that makes them: a piece is (start, length, crc of its ids). Pieces are spread evenly
over partitions of about ``rows_per_task`` pieces, each packed on its own, so memory is bounded and no task sees them
all; what is lost against one bin set is less than an open sequence or two a gap class and partition.

Defined results: a null or empty text is one piece of the end id alone; the string of a special token is its id; null
doc_ids and repeated rows are packed like others; ties of length keep the order in which pieces arrive; columns beside
doc_id and text are not read, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillspark.llm.common import as_batch, batches, checkpointed, give_back

CAPACITY, END_ID, ROWS_PER_TASK = 1024, 2, 65536
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


class FastTokenizer:
    """Ids of texts by a tokenizer file, special tokens' strings being their ids.

    Where the same vocabulary lies beside the file as ranks, a library that needs a quarter of the time makes the same
    ids (``tests/llm`` compares the two on every code point and on odd blanks). What that library refuses (blanks by the
    hundred thousand in a row) goes to the file's own.
    """

    def __init__(self, path: str) -> None:
        self.path, self.plain, self.fast = path, None, None
        ranks = path.removesuffix(".json") + ".tiktoken"
        if path.endswith(".json") and os.path.exists(ranks):
            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            plain = Tokenizer.from_file(path)  # not kept: it takes more memory than the other
            special = {t.content: i for i, t in plain.get_added_tokens_decoder().items()}
            if set(merges.values()) | set(special.values()) == set(range(plain.get_vocab_size())):
                del plain
                give_back()
                self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
            except ValueError:
                pass
        if self.plain is None:
            self.plain = Tokenizer.from_file(self.path)
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4")


_loaded: dict[str, FastTokenizer] = {}


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: only the first may be shorter than ``capacity`` if there are more."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))] if n > capacity else [(0, n)]


def pieces(docs: DataFrame, path: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every row."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _loaded.get(path) or _loaded.setdefault(path, FastTokenizer(path))
        end = np.array([end_id], "<u4")
        for batch in batches(source, "text"):
            row, made = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                data = np.concatenate([tokenizer.ids(text), end]) if text else end
                for k, (start, length) in enumerate(cut(len(data), capacity)):
                    row.append(i)
                    made.append((k, start, length, zlib.crc32(data[start : start + length])))
            table = np.array(made, np.int64).reshape(-1, 4)
            yield as_batch({"doc_id": batch.column(0).take(pa.array(row, pa.int64())), "piece": table[:, 0].astype(np.int32), "start": table[:, 1].copy(), "length": table[:, 2].copy(), "ids_crc32": table[:, 3].copy()})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, by the sum-of-squares rule over the lengths in falling order."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)
    open_by: list[list[int]] = [[] for _ in range(capacity + 1)]
    made, far = 0, 1 << 40
    for i, s in zip(order.tolist(), lengths[order].tolist()):
        # change of the sum, halved: a sequence of gap g becomes one of gap g - s; a full one counts no more
        change = count[: capacity - s] - count[s:capacity] + 1
        change[0] = -count[s]
        change[count[s:capacity] == 0] = far
        best = int(change.argmin()) if len(change) else 0
        if len(change) == 0 or change[best] == far:
            where, gap = made, capacity
            made += 1
        else:
            gap = best + s
            where = open_by[gap].pop()
            count[gap] -= 1
        sequence[i], offset[i] = where, capacity - gap
        if gap > s:
            open_by[gap - s].append(where)
            count[gap - s] += 1
    return sequence, offset


def pack(docs: DataFrame, path: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every row."""
    made = checkpointed(pieces(docs, path, capacity, end_id))
    short = made.where(F.col("length") < capacity)
    full = made.where(F.col("length") == capacity).withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn("offset", F.lit(0).cast("long"))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in source if b.num_rows]
        if rows:
            together = pa.Table.from_batches(rows).combine_chunks()
            sequence, offset = sum_of_squares(together.column("length").to_numpy().astype(np.int64), capacity)
            # even ids: the short pieces' sequences
            ids = (np.int64(TaskContext.get().partitionId()) << np.int64(32) | sequence) * 2
            yield from together.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset)).to_batches()

    tasks = max(1, -(-short.count() // rows_per_task))
    packed = short.repartition(tasks).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return packed.unionByName(full)
