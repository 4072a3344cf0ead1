"""Sharding, mixing, packing and the pipeline: laws, exact recounts, reruns, odd rows."""

import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from quillspark.llm import mixing, packing, sharding


def whole(rows, n):
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(n)]
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    return max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards(sf, odd, none):
    docs = sf("documents")
    rows = sharding.shard(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert whole(rows, 24) and sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(body) + 8, zlib.crc32(body), "rows", None)
    places = defaultdict(set)
    for r in rows:
        places[texts[r.doc_id]].add(r.shard)
    assert sum(len(p) > 1 for p in places.values()) <= 1
    assert whole(sharding.shard(odd).collect(), 24) and sharding.shard(none).count() == 0


def test_shards_of_a_hot_group(spark):
    docs = spark.createDataFrame([(i, "same" if i % 3 == 0 else f"text {i // 2}") for i in range(3000)], "doc_id long, text string")
    rows = sharding.shard(docs, bucket_rows=200).collect()
    assert whole(rows, 24) and len({r.doc_id for r in rows}) == 3000
    # a third of all rows needs eight shards at least
    assert len({r.shard for r in rows if r.doc_id % 3 == 0}) <= 16


def test_sainte_lague_is_the_highest_quotients():
    rng = np.random.default_rng(2)
    for _ in range(20):
        votes, seats = [float(v) for v in rng.integers(0, 500, 6)], int(rng.integers(1, 60))
        ranked = sorted(((-v / (2 * k + 1), i) for i, v in enumerate(votes) if v for k in range(seats)))[:seats]
        assert mixing.sainte_lague(votes, seats) == [sum(i == j for _, j in ranked) for i in range(6)]


def test_targets():
    assert mixing.targets({"a": 100, "b": 100, None: 100}) == {"a": 200.0, "b": pytest.approx(250 * 2 / 3), None: pytest.approx(250 / 3)}
    assert mixing.targets({"z": 10, "é": 10}) == {"z": 20.0, "é": 10.0}
    assert mixing.targets({}) == {}


@pytest.mark.parametrize("rows_per_shard", [20, 65536])
def test_mix(sf, odd, none, rows_per_shard):
    docs = sf("documents")
    rows = mixing.mix(docs, rows_per_shard=rows_per_shard).collect()
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(3), rows_per_shard=rows_per_shard).collect())
    given = {r.doc_id: r for r in docs.collect()}
    size = {d: len((r.text or "").split()) for d, r in given.items()}
    by, taken = Counter(), Counter()
    for r in rows:
        assert r["size"] == size[r.doc_id] and 0 <= r.taken <= 2 * r["size"]
        by[given[r.doc_id].source] += r["size"]
        taken[given[r.doc_id].source] += r.taken
    goal = mixing.targets(dict(by))
    for r in rows:
        source = given[r.doc_id].source
        assert r.source_size == by[source] and r.target == pytest.approx(goal[source])
    assert all(abs(taken[s] - goal[s]) <= max(64, 0.02 * goal[s]) for s in goal)
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(none).count() == 0


def test_mixed_documents_have_the_words_taken(sf, odd, none):
    docs = sf("documents")
    took = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    got = Counter()
    for r in mixing.mixed_documents(docs, rows_per_shard=65536).collect():
        got[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert dict(got) == {d: n for d, n in took.items() if n}
    mixing.mixed_documents(odd).collect()
    assert mixing.mixed_documents(none).count() == 0


def test_packing(sf, odd, none):
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    for docs in (sf("documents"), odd.where("doc_id is not null").dropDuplicates(["doc_id"])):
        rows = packing.pack(docs).collect()
        ids = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in docs.collect()}
        pieces, bins = defaultdict(list), defaultdict(list)
        for r in rows:
            pieces[r.doc_id].append(r)
            bins[r.sequence_id].append((r.offset, r.length))
        assert pieces.keys() == ids.keys()
        for doc, mine in pieces.items():
            at = 0
            for k, r in enumerate(sorted(mine, key=lambda r: r.piece)):
                part = ids[doc][at : at + r.length]
                assert (r.piece, r.start, r.ids_crc32) == (k, at, zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
                assert k == 0 or r.length == 1024
                at += r.length
            assert at == len(ids[doc]) and (len(mine) == 1 or at > 1024)
        for places in bins.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 1024
        assert len(bins) <= 1.05 * sum(map(len, ids.values())) / 1024 + 2
    assert packing.pack(odd).count() >= odd.count() and packing.pack(none).count() == 0


def test_sum_of_squares_places_each_piece_where_the_sum_is_least():
    lengths = np.random.default_rng(4).integers(1, 40, 120)
    sequence, offset = packing.sum_of_squares(lengths, 40)
    gap: dict[int, int] = {}
    for i in np.argsort(-lengths, kind="stable"):
        def total(b):
            after = Counter(v - (lengths[i] if k == b else 0) for k, v in gap.items())
            return sum(n * n for g, n in after.items() if g)

        fits = [b for b, g in gap.items() if g >= lengths[i]]
        b = int(sequence[i])
        if fits:
            assert b in fits and total(b) == min(map(total, fits))
        else:
            assert b not in gap
            gap[b] = 40
        assert offset[i] == 40 - gap[b]
        gap[b] -= int(lengths[i])


def test_ids_are_those_of_the_tokenizer_file(spark):
    plain, fast = Tokenizer.from_file(packing.TOKENIZER), packing.FastTokenizer(packing.TOKENIZER)
    assert fast.fast is not None
    texts = ["", " ", "  a b", "a  b", "a \n b", "a\tb c", " x", "y ", "\n", "a\n\nb", "it's  don't", "<|endoftext|> a", "hello <|endoftext|> world", "<|endoftext", "\x1cb \x85c", "a\u3000b", "é è\nç", "x" * 5000, " " * 300_000 + "x"]
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["|".join(f"a{c}1{c} {c}a{c}{c}!" for c in points[i : i + 8192]) for i in range(0, len(points), 8192)]
    for t in texts:
        assert fast.ids(t).tolist() == plain.encode(t, add_special_tokens=False).ids
    docs = spark.createDataFrame([(1, "hello <|endoftext|> world", "x")], "doc_id long, text string, piece string")
    (row,) = packing.pack(docs).collect()
    ids = [*plain.encode("hello <|endoftext|> world", add_special_tokens=False).ids, 2]
    assert (row.length, row.ids_crc32) == (len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))) and 50256 in ids


def test_pipeline(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.select("doc_id").distinct()
        made = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(made.collect(), made.schema)
        assert docs.select("doc_id").distinct().join(before, "doc_id", "left_anti").count() == 0
        if k < 4:
            assert docs.columns == names and docs.count()
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} == set(docs.columns)
    assert corpus_pipeline.run(spark, sf_dir).count() == docs.count()


def test_pipeline_on_odd_rows_and_an_empty_table(spark, odd, none, tmp_path):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, none):
        names = corpus_pipeline.COLUMNS
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            made = stage(spark, docs, str(tmp_path))
            docs = spark.createDataFrame(made.collect(), made.schema)
            if k < 4:
                assert docs.columns == names
    assert docs.count() == 0


@pytest.mark.parametrize("sizes", [[10] * 6, [3, 1, 1, 500], [5, 40, 7000]])
def test_small_sources_come_near_their_targets(spark, sizes):
    rows = [(1000 * k + i, " ".join(["w"] * min(7, n - 7 * i)), f"s{k}") for k, n in enumerate(sizes) for i in range(-(-n // 7))]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for k in range(len(sizes)):
        mine = [r for r in got if r.doc_id // 1000 == k]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(1, 0.02 * mine[0].target)


def test_equal_rows_are_parted(spark):
    docs = spark.createDataFrame([(None, "a b c", "s")] * 5000 + [(k, "d e", "t") for k in range(500)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, rows_per_shard=1500).collect()
    assert len(rows) == 5500 and all(0 <= r.taken <= 2 * r["size"] for r in rows)
    taken = Counter()
    for r in rows:
        taken[r.target] += r.taken
    assert all(abs(n - goal) <= 0.02 * goal + 2 for goal, n in taken.items())
    assert sorted(r.taken for r in rows) == sorted(r.taken for r in mixing.mix(docs.repartition(5), rows_per_shard=1500).collect())
    full = docs.selectExpr("doc_id", "text", "'en' AS lang", "source", "5L AS n_chars")
    words = sum(len(r.text.split()) for r in mixing.mixed_documents(full, rows_per_shard=1500).collect())
    assert abs(words - sum(taken.values())) <= 0.02 * words
