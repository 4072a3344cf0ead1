"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Sources by code point (null last) weigh 5, 2, 1, repeating, and share ``share`` of all words; a target stops at
``most`` times its source, what is over is shared again by weight until no target is above. A source's whole passes
over its documents come first; the rest of the target is blocks. Its documents lie on lines (shards, by the hash of the
row), each line is cut into equal blocks of about ``block`` words (of a 64th of a source that is smaller than 64
blocks), and Sainte-Lague's highest quotients turn the rest of the target into integer quotas: first by source, then by
groups of shards, then by shard. Each shard then draws its quota with numbers seeded by (seed, source, shard): reruns
agree.

Only totals by source and by group of ``SHARDS`` shards reach the driver; no task sees more than a shard of about
``rows_per_shard`` rows or ``words_per_shard`` words (one document stays whole), however large its source is. Rows equal
in all that counts are pre-aggregated, and many of them are parted.

Defined results: a null or empty text has no words and is never taken; a null source is a source; null doc_ids and
repeated rows are rows like others, of which each takes its own words; ties of quotients go to the earlier source or
shard; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import WORD, checkpointed, give_back

WEIGHTS = (5, 2, 1)
_WORD = re.compile(WORD)
#: Shards a group, and equal rows that stay together.
SHARDS, TOGETHER = 256, 1024
#: Up to how many sources or shards (under 100 bytes each) are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 100_000


def word_count(text: str = "text") -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> dict[str | None, float]:
    """Words to take by source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be", "surrogatepass")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped: dict[str | None, float] = {}
    left = share * sum(sizes.values())
    free = list(order)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return capped | {s: left * weight[s] / total for s in free}
        for s in over:
            capped[s] = most * sizes[s]
        left -= sum(capped[s] for s in over)
        free = [s for s in free if s not in capped]
    return capped


def sainte_lague(votes: list[float], seats: int) -> list[int]:
    """Seats by highest quotients votes / (2 k + 1); ties go to the earlier party.

    All but a few seats per party follow from the common divisor (votes / seats rounded down), the rest are dealt one
    by one from a heap, so the cost is in the parties and not in the seats.
    """
    total = float(sum(votes))
    if not total or seats <= 0:
        return [0] * len(votes)
    quota = [max(0, int(v * seats / total) - 1) for v in votes]
    heap = [(-v / (2 * q + 1), i) for i, (v, q) in enumerate(zip(votes, quota)) if v > 0]
    heapq.heapify(heap)
    for _ in range(seats - sum(quota)):
        _, i = heap[0]
        quota[i] += 1
        heapq.heapreplace(heap, (-votes[i] / (2 * quota[i] + 1), i))
    return quota


def drawn(n_blocks: int, quota: int, words: int, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in words of the line, of ``quota`` blocks of ``n_blocks`` drawn without replacement."""
    chosen = np.sort(np.random.Generator(np.random.Philox(np.random.SeedSequence(seed))).permutation(n_blocks)[:quota])
    return chosen * words // n_blocks, (chosen + 1) * words // n_blocks


def _below(starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many drawn words lie before each place of the line."""
    if not len(starts):
        return np.zeros(len(at), np.int64)
    before = np.concatenate([[0], np.cumsum(ends - starts)])
    k = np.searchsorted(starts, at, side="right") - 1
    inside = np.where(k >= 0, np.minimum(at, ends[np.maximum(k, 0)]) - starts[np.maximum(k, 0)], 0)
    return before[np.maximum(k, 0)] * (k >= 0) + inside


def excerpt(text: str, ranges: list[tuple[int, int]]) -> str:
    """The text from the first to the last word of each range of word numbers, ranges parted by a newline."""
    spans = [m.span() for m in _WORD.finditer(text)]
    return "\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in ranges)


def capped(blocks: list[int], seats: int) -> list[int]:
    """Sainte-Lague's quotas of ``seats``, none above its blocks; what rounds past them goes to others with room."""
    quota = sainte_lague([float(b) for b in blocks], min(seats, sum(blocks)))
    spare = sum(max(0, q - b) for q, b in zip(quota, blocks))
    quota = [min(q, b) for q, b in zip(quota, blocks)]
    for i, b in enumerate(blocks):
        more = min(spare, b - quota[i])
        quota[i] += more
        spare -= more
    return quota


def _same(a: DataFrame, b: DataFrame, rows: int, *names: str) -> DataFrame:
    """Inner join on ``names``, null equal to null; b's names go. ``b`` has about ``rows`` rows, and is broadcast if these are few."""
    b = F.broadcast(b) if rows <= MOST_BROADCAST else b
    on = [a[n].eqNullSafe(b[n]) for n in names]
    joined = a.join(b, on)
    for n in names:
        joined = joined.drop(b[n])
    return joined


def _plan(rows: DataFrame, share: float, most: float, block: int, rows_per_shard: int, words_per_shard: int) -> DataFrame | None:
    """``rows`` (source, size, place, copies and others) with their shard, and its words, blocks, quota and passes."""
    spark = rows.sparkSession
    per = {r["source"]: (r["n"], r["words"]) for r in rows.groupBy("source").agg(F.sum("copies").alias("n"), F.sum(F.col("size") * F.col("copies")).alias("words")).collect()}
    if not per:
        return None
    shards = {s: max(1, -(-n // rows_per_shard), -(-w // words_per_shard)) for s, (n, w) in per.items()}
    goal = targets({s: w for s, (_, w) in per.items()}, share, most)
    passes = {s: min(int(most), int(goal[s] // w)) if w else 0 for s, (_, w) in per.items()}
    rest = {s: max(0.0, goal[s] - passes[s] * per[s][1]) for s in per}
    size = {s: max(1, min(block, w // 64)) for s, (_, w) in per.items()}
    grain = min(size.values())
    order = sorted(per, key=lambda s: (s is None, s or ""))
    words = dict(zip(order, (q * grain for q in sainte_lague([rest[s] for s in order], round(sum(rest.values()) / grain)))))
    about = spark.createDataFrame([(s, shards[s], size[s], passes[s], per[s][1], goal[s]) for s in per], "source string, shards int, block int, passes int, source_size long, target double")
    placed = _same(rows, about, len(per), "source").withColumn("shard", F.pmod("place", F.col("shards").cast("long")).cast("int"))
    totals = placed.groupBy("source", "shard", "block").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
    blocks = F.when(F.col("words") > 0, F.greatest(F.lit(1), F.round(F.col("words") / F.col("block")))).otherwise(0).cast("long")
    totals = checkpointed(totals.withColumn("blocks", blocks).withColumn("group", (F.col("shard") / SHARDS).cast("int")))
    groups: dict = {}
    for r in totals.groupBy("source", "group").agg(F.sum("blocks").alias("blocks")).orderBy("group").collect():
        groups.setdefault(r["source"], []).append((r["group"], r["blocks"]))
    quotas = [(s, g, q) for s, found in groups.items() for (g, _), q in zip(found, capped([b for _, b in found], round(words[s] / size[s])))]
    seats = spark.createDataFrame(quotas, "source string, group int, seats long")

    def deal(data: pa.Table) -> pa.Table:
        data = data.sort_by("shard")
        return data.select(["source", "shard", "words", "blocks"]).append_column("quota", pa.array(capped(data.column("blocks").to_pylist(), data.column("seats")[0].as_py()), pa.int64()))

    dealt = _same(totals, seats, len(quotas), "source", "group").groupBy("source", "group").applyInArrow(deal, "source string, shard int, words long, blocks long, quota long")
    return _same(placed, checkpointed(dealt), sum(shards.values()), "source", "shard")


def _rows(docs: DataFrame, seed: int, *extra: str) -> DataFrame:
    return docs.select("doc_id", "source", word_count().alias("size"), F.xxhash64(F.lit(seed), "doc_id", F.coalesce(F.col("text"), F.lit(""))).alias("place"), *extra)


def _parted(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` with their number of ``copies``, in parts of TOGETHER at most that lie apart."""
    part = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / TOGETHER).cast("long"))).alias("part")
    many = rows.select("*", part)
    return many.withColumn("copies", F.least(F.lit(TOGETHER), F.col("n") - F.col("part") * TOGETHER)).withColumn("place", F.when(F.col("part") > 0, F.xxhash64(F.lit(seed), "place", "part")).otherwise(F.col("place"))).drop("n", "part")


def _seed(seed: int, source: str | None, shard: int) -> list[int]:
    return [seed, *((source or "").encode() + bytes([source is None]))] + [shard]


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, block: int = 32, rows_per_shard: int = 65536, words_per_shard: int = 1 << 26, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``."""
    rows = checkpointed(_parted(_rows(docs, seed).groupBy("doc_id", "source", "size", "place").agg(F.count("*").alias("n")), seed))
    planned = _plan(rows, share, most, block, rows_per_shard, words_per_shard)
    if planned is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, size long, source_size long, target double, taken long")

    def take(data: pa.Table) -> pa.Table:
        data = data.sort_by([("place", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
        copies = data.column("copies").to_numpy()
        if (copies > 1).any():
            data = data.take(pa.array(np.repeat(np.arange(data.num_rows), copies)))
        size = data.column("size").to_numpy()
        source, shard, words, blocks, quota, passes = (data.column(c)[0].as_py() for c in ("source", "shard", "words", "blocks", "quota", "passes"))
        end = np.cumsum(size)
        starts, ends = drawn(blocks, quota, words, _seed(seed, source, shard))
        part = _below(starts, ends, end) - _below(starts, ends, end - size)
        return data.select(["doc_id", "size", "source_size", "target"]).append_column("taken", pa.array(passes * size + part, pa.int64()))

    return planned.groupBy("source", "shard").applyInArrow(take, "doc_id long, size long, source_size long, target double, taken long")


def mixed_documents(docs: DataFrame, share: float = 1.5, most: float = 2.0, block: int = 32, rows_per_shard: int = 65536, words_per_shard: int = 1 << 20, seed: int = 7) -> DataFrame:
    """The mix as documents: a row per whole pass over a document, and one with the words of its drawn blocks.

    Columns are those of ``docs`` (doc_id, text, lang, source, n_chars); n_chars is that of the row's text.
    """
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = _rows(docs, seed, "lang")
    keys = ("doc_id", "source", "size", "place", "lang")
    if rows.groupBy(*keys).count().where(F.col("count") > TOGETHER).isEmpty():
        parted = _rows(docs, seed, "lang", "text").withColumn("copies", F.lit(1).cast("long"))
    else:  # texts go with the pre-aggregated rows
        parted = _parted(_rows(docs, seed, "lang", "text").groupBy(*keys).agg(F.count("*").alias("n"), F.min("text").alias("text")), seed)
    planned = _plan(parted, share, most, block, rows_per_shard, words_per_shard)
    if planned is None:
        return docs.select(names)

    def take(data: pa.Table) -> pa.Table:
        data = data.sort_by([("place", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
        copies = data.column("copies").to_numpy()
        if (copies > 1).any():
            data = data.take(pa.array(np.repeat(np.arange(data.num_rows), copies)))
        size = data.column("size").to_numpy()
        source, shard, words, blocks, quota, passes = (data.column(c)[0].as_py() for c in ("source", "shard", "words", "blocks", "quota", "passes"))
        starts, ends = drawn(blocks, quota, words, _seed(seed, source, shard))
        line = np.cumsum(size) - size
        out: dict[str, list] = {"doc_id": [], "text": [], "lang": []}
        for doc, text, lang, at, n in zip(data.column("doc_id").to_pylist(), data.column("text").to_pylist(), data.column("lang").to_pylist(), line.tolist(), size.tolist()):
            texts = [text] * (passes if n else 0)
            lo, hi = np.searchsorted(ends, at, side="right"), np.searchsorted(starts, at + n, side="left")
            ranges: list[tuple[int, int]] = []
            for a, b in zip(starts[lo:hi].tolist(), ends[lo:hi].tolist()):
                a, b = max(a - at, 0), min(b - at, n)
                if a < b:
                    ranges[-1:] = [(ranges[-1][0], b)] if ranges and ranges[-1][1] == a else [*ranges[-1:], (a, b)]
            if ranges:
                texts.append(text if ranges == [(0, n)] else excerpt(text, ranges))
            for t in texts:
                for column, value in zip(out.values(), (doc, t, lang)):
                    column.append(value)
        n = len(out["doc_id"])
        give_back()
        return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "text": pa.array(out["text"], pa.string()), "lang": pa.array(out["lang"], pa.string()), "source": pa.array([source] * n, pa.string()), "n_chars": pa.array([len(t) for t in out["text"]], pa.int64())})

    return planned.groupBy("source", "shard").applyInArrow(take, "doc_id long, text string, lang string, source string, n_chars long")
