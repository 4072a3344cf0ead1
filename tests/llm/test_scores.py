"""Quality, toxicity and language: held-out accuracy, odd rows, empty tables."""

import zlib

import pyarrow as pa
import pytest

from quillspark.llm import langid, quality, toxicity

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{BIG}/{n}.parquet") for n in ("documents", "labels")]


def held(doc, modulus, rest):
    return doc is not None and zlib.crc32(str(doc).encode()) % modulus == rest


def test_quality_separates_held_out_labels(tables):
    docs, labels = tables
    got = quality.score(docs, quality.fit_tables(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, 4, 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    test = [r for r in got if r.held_out]
    assert sum(r.predicted == r.quality for r in test) >= 0.9 * len(test)


def test_toxicity_separates_held_out_labels(tables):
    docs, labels = tables
    got = toxicity.score(docs, toxicity.fit_tables(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == held(r.doc_id, 5, 0) and r.predicted == (r.score >= 0.5) for r in got)
    test = [r for r in got if r.held_out]
    assert sum(r.predicted == r.toxic for r in test) >= 0.9 * len(test)


def test_language_of_held_out_documents(tables):
    docs, _ = tables
    got = langid.predict(docs, langid.fit_table(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in got if r.held_out]
    assert all(r.held_out == held(r.doc_id, 5, 0) for r in got)
    assert sum(r.lang_pred == r.lang for r in test) >= 0.97 * len(test)


def idiots():
    names = "abcdefghij"
    sample = [(f"he said idiot and the talk is {w}".encode(), 1) for w in names] + [(f"he said and the talk is {w}".encode(), 0) for w in names]
    return toxicity.fit(sample * 3)


@pytest.mark.parametrize("hidden", ["i d i o t", "id iot", "i\nd\ti  o t", "a i d i o t", "i . d . i . o . t", "1 d 1 0 t", "he is an id io t.", ".".join("idiot") + "." * 60 + "x" + "-" * 40, "i" + "-" * 80 + "diot", "$" * 40 + "!diot"])
def test_split_and_long_words_are_restored(hidden):
    model = idiots()
    assert model.score(pa.array([f"he said {hidden} there".encode(), b"he said so there", b"i did it, and i do", b"a b c d e f"])).round().tolist() == [1, 0, 0, 0]


@pytest.mark.parametrize("hidden", ["1d10t", "i.d.i.o.t", "idiooot", "i-d-i-o-t", "IDIOT!!", "!diot"])
def test_obfuscated_words_are_restored(hidden):
    model = idiots()
    assert toxicity.restore(hidden.lower(), model.characters, model.known) == "idiot"
    assert model.score(pa.array([f"he said {hidden} there".encode(), b"he said so there", b"an i d i o t is it"])).round().tolist() == [1, 0, 1]


def test_viterbi_is_the_cheapest_reading():
    from itertools import product

    model = toxicity.fit_characters({"stop": 5, "step": 3, "toast": 2})
    for token in ("st0p", "5tep", "t0a5t", "sttop", "s.t.e.p"):
        def price(arcs):
            total, before = sum(c for _, c in arcs), "  "
            for letter, _ in arcs:
                if letter:
                    total, before = total + model.cost(before, letter), before[1] + letter
            return total + model.cost(before, " ")

        best = min(product(*toxicity.lattice(token)), key=price)
        assert price(best) == pytest.approx(min(price(p) for p in product(*toxicity.lattice(token))))
        assert toxicity.viterbi(token, model) == "".join(c for c, _ in best)


def test_odd_rows_and_empty_tables(odd, none, no_labels):
    q, t, m = quality.fit_tables(odd, no_labels), toxicity.fit_tables(odd, no_labels), langid.fit_table(odd)
    for frame in (quality.score(odd, q), toxicity.score(odd, t), langid.predict(odd, m)):
        rows = frame.collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert {r.doc_id: r.lang_pred for r in langid.predict(odd, m).collect()}[7] == "und"
    assert toxicity.accepted(odd, t).columns == odd.columns
    for frame in (quality.score(none, q), toxicity.score(none, t), langid.predict(none, langid.fit_table(none))):
        assert frame.count() == 0
    assert {r.lang_pred for r in langid.predict(odd, langid.fit_table(none)).collect()} == {"und"}


def test_toxicity_counts_trigrams_of_all_documents_and_keeps_all_words(spark):
    bad = ["".join(chr(97 + (k * 7 + i * (3 + k % 5)) % 26) for i in range(6)) + chr(97 + k // 26) + chr(97 + k % 26) for k in range(200)]
    rows = [(i, f"fine words here {' '.join(bad[i % 40 :: 40])}" if i % 2 else "fine words here and there") for i in range(1200)]
    rows += [(5000, "żółw жук żółw"), (5001, "x" * 20000 + " straße")]  # no labels, and over the sample's bytes
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1200)], "doc_id long, toxic int")
    counts = toxicity.count_trigrams(docs)
    assert counts["żół"] == 2 and counts["жук"] == 1 and counts["fin"] == 1200 and counts["ße "] == 1 and "xxx" not in counts
    model = toxicity.fit_tables(docs, labels)
    assert "жук" in model.characters.costs and "aße" in model.characters.costs
    assert set(bad[1::2]) <= model.known  # texts of odd ids have these; more than 160 features with their beginnings
    assert len(model.weights) > 160


def test_quality_scores_against_plain_compression(spark, tables):
    import math

    import zstandard

    docs, labels = tables
    model = quality.fit_tables(docs, labels)
    some = docs.where("doc_id < 300")
    given = {r.doc_id: (r.text or "").encode() for r in some.collect()}

    def size(raw, text):
        with_ = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=False, write_checksum=False, write_dict_id=False, level=3)
        return sum(len(with_.compress(text[at : at + 1024])) for at in range(0, len(text), 1024))

    for r in quality.score(some, model).collect():
        text = given[r.doc_id]
        difference = (size(model.bad, text) - size(model.good, text)) / len(text) if text else 0
        assert r.score == pytest.approx(1 / (1 + math.exp(-model.slope * difference - model.intercept)), rel=1e-9)


def test_language_scores_against_plain_naive_bayes():
    import math

    rows = [("the cat and the dog", "en"), ("el gato y el perro", "es"), ("le chat et le chien \0 x", "fr"), ("thé", "fr")]
    model = langid.fit(rows)
    mask = (1 << 32) - 1

    def grams(text):
        low = [ord(c) for c in text.lower()]
        for i in range(len(low)):
            value = 0
            for order, by in enumerate((0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)):
                value = (value * 31 + (low[i + order] if i + order < len(low) else 0) * by) & mask
                yield order, ((value * 0x9E3779B1) & mask) >> 18

    counts = {}
    for text, lang in rows:
        for g in grams(text):
            counts[lang, g] = counts.get((lang, g), 0) + 1
    sums = {(lang, o): sum(n for (la, g), n in counts.items() if la == lang and g[0] == o) + 0.5 * langid.BUCKETS for lang in ("en", "es", "fr") for o in range(3)}
    texts = ["the gato", "xyz", "le", "the gato et " * 40, "a\0b", "12", "", None]
    langs, score = model.predict(texts)
    for k, text in enumerate(texts):
        if not text or text == "12":
            assert (langs[k], score[k]) == ("und", 0)
            continue
        n = len(text)
        logs = {lang: sum(math.log((counts.get((lang, g), 0) + 0.5) / sums[lang, g[0]]) for g in grams(text)) / n * (n * 50 / (n + 50)) + math.log(((lang == "fr") + 2) / 7) for lang in ("en", "es", "fr")}
        best = max(logs, key=logs.get)
        assert langs[k] == best and score[k] == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs.values()), rel=1e-4)
        assert model.predict([text])[1][0] == score[k]  # whatever stands beside it


def test_sparse_logistic_is_the_dense_one():
    import numpy as np

    from quillspark.llm.common import logistic, sparse_logistic

    rng = np.random.default_rng(8)
    x = (rng.random((120, 9)) < 0.3).astype(float)
    y = (rng.random(120) < 0.2 + 0.6 * x[:, 0]).astype(float)
    lists = [[*np.flatnonzero(r).tolist(), 9] for r in x]
    assert sparse_logistic(lists, 10, y, np.ones(120), 1.0) == pytest.approx(logistic(x, y, 1.0), abs=1e-6)
    half = [lists[i] for i in range(60)]
    assert sparse_logistic(half, 10, y[:60], np.full(60, 2.0), 1.0) == pytest.approx(logistic(np.vstack([x[:60]] * 2), np.hstack([y[:60]] * 2), 1.0), abs=1e-6)
