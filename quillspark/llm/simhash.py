"""SimHash near-duplicates through pivot distance tables.

``fingerprints`` makes the 64-bit majority of XXH64 shingle hashes. ``links`` finds all pairs of distinct fingerprints
that differ in at most two bits:

* the pivot table holds every fingerprint's Hamming distances to sixteen fixed reference fingerprints;
* candidates share three of five blocks of bits (two changed bits leave three blocks alone), so ten equi-joins on
  keys of 38 bits or more find them all, without a cross join;
* a pair whose distances to some pivot differ by more than two is discarded (triangle inequality), the survivors are
  verified by the bits of their XOR.

Keys shared by more than ``hot`` distinct fingerprints are not paired: their members meet in single-bit variants.
Two fingerprints differ in at most two bits exactly if they share a variant with at most one bit changed, so one star
per variant (65 rows a fingerprint) links the same components. Equal fingerprints are one row from the start.

``near_duplicates`` is the operator for texts: five-word shingles and a Jaccard similarity of 0.8. At this similarity
fingerprints differ in about ten of 64 bits, too many for keys of whole blocks, so its candidates come from an exact
prefix filter on shingles, rarest first: it misses no pair. Candidates must pass the pivot test with the wider distance
of ``MOST`` bits (six standard deviations above what 0.8 gives; texts of few shingles skip it), and are verified by
the shingles themselves.

Defined results: a null or empty text has the fingerprint 0 and is linked like any other; a null doc_id is linked but
is never a component's id unless all its members are null; repeated rows come out once each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import as_batch, batches, checkpointed, text_bytes
from quillspark.llm.components import components
from quillspark.llm.rolling import Rolling, chain

SEED = 42
PIVOTS = [xxhash.xxh64_intdigest(b"pivot %d" % i, SEED) for i in range(16)]
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
#: Buckets of the counts that order shingles from rare to common, and how many of the largest a task reports.
SKETCH, REPORTED = 1 << 20, 8192
#: The pivot test of near-duplicates: how many bits may differ, and from how many shingles on it applies.
MOST, ENOUGH = 28, 64
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32)
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\v\f"))
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def shingles(body: bytes, width: int) -> list[bytes]:
    """The ``width``-word shingles of a text, repeats included; the whole sequence if it has fewer words."""
    words = body.lower().split()  # bytes: only A-Z change, and exactly space and \t\n\v\f\r part words
    if len(words) <= width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)))))


def hashes(body: bytes, width: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in shingles(body, width)], np.uint64)


def _sums(h: np.ndarray) -> np.ndarray:
    """By row of ``h`` [words, n] and bit (most significant first), in how many hashes the bit is set."""
    count = len(h)
    octets = h.astype(">u8").view(np.uint8).reshape(count, -1, 8)
    offset = (np.arange(count)[:, None, None] * 8 + np.arange(8)) * 256
    table = np.bincount((octets + offset).ravel(), minlength=count * 2048).reshape(count, 8, 256).astype(np.float32)
    return (table @ _BITS).reshape(count, 64)


def fingerprint(h: np.ndarray) -> int:
    """Bits set in over half the hashes; 0 without hashes."""
    if not len(h):
        return 0
    bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64) if len(h) < 200 else _sums(h[None])[0]
    return int.from_bytes(np.packbits(bits * 2 > len(h)).tobytes(), "big")


def shingle_sets(bodies: list[bytes], width: int) -> list[np.ndarray]:
    """By text, the sorted distinct rolling hashes of its ``width``-word shingles (of the whole sequence if it is shorter)."""
    data = _LOWER[np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)]
    bounds = np.cumsum(np.array([len(b) + 1 for b in bodies], np.int64))
    blank = _SPACE[data]
    before = np.concatenate([[True], blank[:-1]])
    start, stop = np.flatnonzero(before & ~blank), np.flatnonzero(blank & ~before)
    words = Rolling(data).hash(start, stop)
    last = np.searchsorted(start, bounds)
    first = np.concatenate([[0], last[:-1]])
    rows = chain(words, width)
    return [np.unique(rows[a : b - width + 1]) if b - a >= width else chain(words[a:b], b - a) if b > a else rows[:0] for a, b in zip(first.tolist(), last.tolist())]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a long) of every row."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source):
            yield as_batch({"doc_id": batch.column(0), "fp": pa.array([_signed(fingerprint(hashes(t, width))) for t in batch.column(1).to_pylist()], pa.int64())})

    return text_bytes(docs, "doc_id").mapInArrow(run, "doc_id long, fp long")


def pivot_distances(fp: str) -> list[Column]:
    return [F.bit_count(F.col(fp).bitwiseXOR(F.lit(_signed(p)))).cast("tinyint") for p in PIVOTS]


def survives(a: str, b: str, most: int) -> Column:
    """Whether no coordinate of the two pivot rows differs by more than ``most``."""
    return F.greatest(*(F.abs(F.col(f"{a}{i}").cast("int") - F.col(f"{b}{i}").cast("int")) for i in range(len(PIVOTS)))) <= most


def _hamming(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(distinct: DataFrame, hot: int = 32) -> DataFrame:
    """(a, b): edges between distinct fingerprints (column fp) at most two bits apart, enough to give all components."""
    keys = []
    for t, kept in enumerate(combinations(BLOCKS, 3)):
        mask = sum(((1 << n) - 1) << at for at, n in kept)
        keys.append(F.struct(F.lit(t).cast("tinyint").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key")))
    keyed = distinct.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.t", "k.key")
    counts = keyed.groupBy("t", "key").count().where("count > 1")
    shared = checkpointed(keyed.join(counts, ["t", "key"]))
    table = shared.where(F.col("count") <= hot).select("t", "key", "fp", *[d.alias(f"p{i}") for i, d in enumerate(pivot_distances("fp"))])
    left = table.select("t", "key", F.col("fp").alias("a"), *[F.col(f"p{i}").alias(f"x{i}") for i in range(len(PIVOTS))])
    right = table.select("t", "key", F.col("fp").alias("b"), *[F.col(f"p{i}").alias(f"y{i}") for i in range(len(PIVOTS))])
    cold = left.join(right, ["t", "key"]).where((F.col("a") < F.col("b")) & survives("x", "y", 2) & (_hamming("a", "b") <= 2)).select("a", "b")
    variants = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    met = shared.where(F.col("count") > hot).select("fp").distinct().select("fp", F.explode(variants).alias("variant"))
    star = met.groupBy("variant").agg(F.min("fp").alias("b"))
    warm = met.join(star, "variant").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return cold.unionByName(warm).distinct()


def component_ids(docs: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least doc_id reachable) for every row of ``docs``."""
    prints = checkpointed(fingerprints(docs, width))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct.select("fp")))
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of = joined.join(ids, "root").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _jaccard_pairs(texts: DataFrame, pairs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose shingle sets have a Jaccard similarity of at least ``similarity``.

    ``texts`` holds (node, body), once a node. The bodies go in by two joins, candidates only.
    """

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in source:
            for batch in batches([whole], "left", 1_000_000):
                left, right = (shingle_sets(batch.column(i).to_pylist(), width) for i in (2, 3))
                both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right)])
                total = np.array([len(x) + len(y) for x, y in zip(left, right)]) - both
                yield as_batch({"a": batch.column(0), "b": batch.column(1)}).filter(pa.array((both >= similarity * total - 1e-9) & (total > 0)))

    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("body").alias("left")), "a")
    with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("body").alias("right")), "b")
    return with_b.select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _sketch(texts: DataFrame, width: int) -> np.ndarray:
    """By bucket of shingle hashes, about how many texts (node, body) have one: fixed size, whatever the input.

    A task reports its largest buckets only. The counts give an order, and any order is exact.
    """

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SKETCH, np.int64)
        for batch in batches(source, most=1_000_000):
            found = shingle_sets(batch.column(1).to_pylist(), width)
            total += np.bincount((np.concatenate(found) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        at = np.argpartition(-total, REPORTED)[:REPORTED]
        at = np.sort(at[total[at] > 1])
        yield as_batch({"bucket": pa.array(at, pa.int32()), "n": pa.array(total[at], pa.int64())})

    counted = texts.select("node", "body").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SKETCH, np.int64)
    counts[np.asarray(counted.column("bucket"))] = np.asarray(counted.column("n"))
    return counts


def prefix_length(n: int, similarity: float) -> int:
    """How many of the rarest of a text's ``n`` shingles to compare.

    Two sets of a Jaccard similarity of t share at least t of the larger one's shingles, so both have one in common among
    the first of any fixed order.
    """
    return n - math.ceil(similarity * n - 1e-9) + 1


def enough(keys: str, na: str, nb: str, similarity: float) -> Column:
    """Whether two texts with so many shared ``keys`` and such sizes can be near.

    Sets of a similarity of t share t / (1 + t) of their sizes' sum. Of the two prefixes, take the one that ends first in
    the fixed order: what it shares lies in the other's prefix too, and beyond it the text has ceil(tn) - 1 shingles.
    """
    share = F.ceil(similarity / (1 + similarity) * (F.col(na) + F.col(nb)) - 1e-9)
    beyond = F.ceil(similarity * F.greatest(na, nb) - 1e-9) - 1
    return (F.least(na, nb) >= similarity * F.greatest(na, nb) - 1e-6) & (F.col(keys) >= share - beyond)


def marks(texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """(node, fp, size, keys) of every distinct text (node, body): the shingles it is looked up by, the rarest."""
    shared = texts.sparkSession.sparkContext.broadcast(_sketch(texts, width))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches(source, most=1_000_000):
            found = shingle_sets(batch.column(1).to_pylist(), width)
            fp, keys = [], []
            for h in found:
                most = prefix_length(len(h), similarity) if len(h) else 0
                keys.append(h[np.argsort(counts[(h % np.uint64(SKETCH)).astype(np.int64)], kind="stable")[:most]].view(np.int64))
                fp.append(_signed(fingerprint(h)))
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys), pa.int64()))
            yield as_batch({"node": batch.column(0), "fp": pa.array(fp, pa.int64()), "size": pa.array([len(h) for h in found], pa.int32()), "keys": lists})

    return texts.select("node", "body").mapInArrow(run, "node long, fp long, size int, keys array<long>").dropDuplicates(["node"])


def shared_keys(marked: DataFrame) -> DataFrame:
    """(key, n, node, size, fp): the keys that several of the texts in ``marked`` have.

    Keys are counted first, by themselves; only rows of shared keys go on to the texts' sizes.
    """
    numbered = checkpointed(marked.withColumn("row", F.monotonically_increasing_id()))
    each = numbered.select("row", F.explode("keys").alias("key"))
    counts = each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return checkpointed(each.join(counts, "key").join(numbered.select("row", "node", "size", "fp"), "row").drop("row"))


def passes(fa: str, fb: str, na: str, nb: str, most: int) -> Column:
    """The pivot test: whether no pivot's distances to two fingerprints differ by more than ``most``."""
    differences = [F.abs(x.cast("int") - y.cast("int")) for x, y in zip(pivot_distances(fa), pivot_distances(fb))]
    return (F.least(na, nb) < ENOUGH) | (F.greatest(*differences) <= most)


def star_pairs(shared: DataFrame, similarity: float) -> DataFrame:
    """(a, b): every text with the least text of its shared keys, if these keys, sizes and fingerprints let them be near."""
    hubs = shared.groupBy("key").agg(F.min(F.struct("node", "size", "fp")).alias("hub")).select("key", F.col("hub.node").alias("a"), F.col("hub.size").alias("na"), F.col("hub.fp").alias("fa"))
    met = shared.join(hubs, "key").where(F.col("node") != F.col("a")).groupBy("a", F.col("node").alias("b")).agg(F.count("*").alias("k"), *[F.first(c).alias(c) for c in ("na", "fa", "size", "fp")])
    return met.where(enough("k", "na", "size", similarity) & passes("fa", "fp", "na", "size", MOST)).select("a", "b")


def prefix_pairs(shared: DataFrame, roots: DataFrame, similarity: float, block: int = 2000) -> DataFrame:
    """(a, b): all pairs with shared keys that can be near and aren't linked in ``roots`` (node, root) yet.

    Keys of more than ``block`` texts are joined block by block; keys whose texts are all linked are left out.
    """
    rows = checkpointed(shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    mixed = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    met = rows.join(mixed, "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    left = met.select("key", F.col("own").alias("i"), every.alias("j"), F.col("node").alias("x"), F.col("size").alias("nx"), F.col("fp").alias("fx"), F.col("root").alias("rx"))
    right = met.select("key", F.col("own").alias("j"), every.alias("i"), F.col("node").alias("y"), F.col("size").alias("ny"), F.col("fp").alias("fy"), F.col("root").alias("ry"))
    close = (F.col("rx") != F.col("ry")) & (F.col("x") < F.col("y")) & (F.least("nx", "ny") >= similarity * F.greatest("nx", "ny") - 1e-6)
    joined = left.join(right, ["key", "i", "j"]).where(close & passes("fx", "fy", "nx", "ny", MOST)).groupBy("x", "y").agg(F.count("*").alias("k"), F.first("nx").alias("nx"), F.first("ny").alias("ny"))
    return checkpointed(joined.where(enough("k", "nx", "ny", similarity)).select(F.col("x").alias("a"), F.col("y").alias("b")))


def _bodies(texts: DataFrame, pairs: DataFrame, most: int = 500_000) -> DataFrame:
    """(node, body) of the texts in ``pairs``, once each; up to ``most`` of these (8 bytes each) are broadcast."""
    needed = checkpointed(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct())
    few = needed.count() <= most
    return checkpointed(texts.join(F.broadcast(needed) if few else needed, "node", "left_semi").dropDuplicates(["node"]))


def near_duplicates(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """text_key and root for every distinct text that is near another: equal roots, one near-duplicate group.

    Texts are near if the Jaccard similarity of their ``width``-word shingle sets is ``similarity`` or more; groups
    are the components of these links. text_key is the XXH64 of the text's bytes with a second seed mixed in
    (``text_key``). Texts that share a key meet the key's least text first, which links most copies; all pairs with a
    shared key that this leaves apart are compared after that. Every pair that is near shares a key.
    """
    texts = docs.select(text_key().alias("node"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("body"))
    shared = shared_keys(marks(texts, width, similarity))
    stars = checkpointed(star_pairs(shared, similarity))
    edges = checkpointed(_jaccard_pairs(_bodies(texts, stars), stars, width, similarity))
    roots = checkpointed(components(edges))
    rest = prefix_pairs(shared, roots, similarity)
    if rest.isEmpty():
        return roots.withColumnRenamed("node", "text_key")
    more = _jaccard_pairs(_bodies(texts, rest), rest, width, similarity)
    linked = roots.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(checkpointed(linked.unionByName(more))).withColumnRenamed("node", "text_key")


def text_key() -> Column:
    """64 bits of a document's text (null: empty): equal texts agree, different ones differ but for 2^-64."""
    return F.xxhash64(F.lit("text"), F.coalesce(F.col("text"), F.lit("")))


def one_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the least doc_id (nulls last, then by text).

    Equal texts are one group whatever their length. All columns are kept as they are.
    """
    own = "_near_key"
    groups = near_duplicates(docs, width, similarity)
    keys = docs.select("doc_id", text_key().alias("text_key"))
    least = keys.groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    grouped = least.join(groups, "text_key", "left").select("text_key", "doc_id", F.coalesce("root", "text_key").alias("root"))
    best = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("best"))
    chosen = best.select(F.col("best.text_key").alias(own), F.col("best.doc_id").alias("_near_id"))
    keyed = docs.withColumn(own, text_key())
    kept = keyed.join(chosen, own).where(F.col("doc_id").eqNullSafe(F.col("_near_id")))
    return kept.dropDuplicates([own]).select(*docs.columns)
