"""SimHash links, near-duplicates, I-Match and line chunks against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from quillspark.llm import components, imatch, linechunks, simhash


def plain_fingerprint(text, width=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def roots(values, near):
    up = list(range(len(values)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return [find(i) for i in range(len(values))]


def test_components_of_documents(sf):
    rows = sorted(simhash.component_ids(sf("documents")).collect())
    texts = {r.doc_id: r.text for r in sf("documents").collect()}
    prints = [plain_fingerprint(texts[r.doc_id]) for r in rows]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    found = roots(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    assert [r.component_id for r in rows] == [rows[k].doc_id for k in found]


@pytest.mark.parametrize("hot", [4, 32])
def test_links_with_hot_keys(spark, hot):
    rng = random.Random(hot)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(14):  # chains of changed bits: keys shared by many
            base ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3])))
            values.add(base)
    values = sorted(values)
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    got = {r.node: r.root for r in components.components(simhash.links(frame, hot)).collect()}
    mine = [got.get(simhash._signed(v), simhash._signed(v)) for v in values]
    want = roots(values, lambda a, b: (a ^ b).bit_count() <= 2)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_odd_rows(odd, none):
    rows = simhash.component_ids(odd).collect()
    assert len(rows) == odd.count()
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {3}
    assert simhash.component_ids(none).count() == 0


def test_near_duplicates_stage(spark, odd, none):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    base = [[rng.choice(words) for _ in range(300)] for _ in range(20)]
    rows, k = [], 0
    for b in base:
        for edits in (0, 1, 2, 3):  # up to 15 of 296 shingles change
            t = list(b)
            for at in rng.sample(range(20, 280), edits):
                t[at] = "x" + t[at]
            rows.append((k, " ".join(t)))
            k += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r.doc_id for r in simhash.one_of_each(docs).collect())
    # every group keeps its first; candidates are found with a probability, so a few copies may stay
    assert {4 * i for i in range(20)} <= set(kept) and len(kept) <= 20 + 3
    left = simhash.one_of_each(odd)
    assert left.columns == odd.columns and sorted(r.doc_id for r in left.collect() if r.doc_id) == [1, 3, 5, 6, 7]
    assert simhash.one_of_each(none).count() == 0


def test_imatch(sf, odd, none):
    docs = sf("documents")
    lexicon = imatch.fit_lexicon(docs)
    rows = sorted(imatch.compare(docs, lexicon, parts=5).collect())
    texts = [r.text for r in sorted(docs.collect())]
    after = texts[1:] + texts[:1]
    assert [r.edited_sha256 for r in rows] == [hashlib.sha256((t[: len(t) - len(t) // 2] + n[: len(t) // 2]).encode()).hexdigest() for t, n in zip(texts, after)]
    assert [r.n_chars for r in rows] == list(map(len, texts))
    same = {}
    for r, t in zip(rows, texts):
        assert same.setdefault(t, r.fingerprint) == r.fingerprint
    assert np.mean([r.near_edited for r in rows]) > 3 * np.mean([r.near_next for r in rows])
    # brute force of the frequency band
    import re

    terms = [{re.sub(r"^[\W_]+|[\W_]+$", "", w) for w in t.lower().split()} - {""} for t in texts]
    count: dict = {}
    for s in terms:
        for b in {int(imatch._bucket(imatch.term_hashes([w]))[0]) for w in s}:
            count[b] = count.get(b, 0) + 1
    assert set(np.flatnonzero(lexicon.bits)) == {b for b, n in count.items() if 2 <= n <= 0.2 * len(texts)}
    assert imatch.compare(odd, imatch.fit_lexicon(odd), parts=3).count() == odd.count()
    assert imatch.compare(none, imatch.fit_lexicon(none)).count() == 0


def test_line_chunks(spark, odd, none):
    rng = random.Random(1)

    def words(n):
        return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n))

    passage = ". ".join(words(9) for _ in range(7)) + "."
    rows = [(i, f"{words(30)}.\n{passage}\n{words(30)}.") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in linechunks.dedup(docs).collect()}
    assert got[0].text == rows[0][1]
    for i, text in rows[1:]:
        assert got[i].text == text.replace(passage + "\n", "") and got[i].removed_chunks > 0
    # an inserted line shifts all others, the passage is still found
    more = spark.createDataFrame([(0, passage), (1, f"{words(25)}\n\n{words(3)}\n{passage}")], "doc_id long, text string")
    assert passage not in {r.doc_id: r.text for r in linechunks.dedup(more).collect()}[1]
    left = linechunks.dedup(odd)
    assert left.count() == odd.count() and left.columns == [*odd.columns, "removed_chunks"]
    assert {r.doc_id: r.text for r in left.collect()}[4] is None
    assert linechunks.dedup(none).count() == 0


def plain_lines(body):
    """(start, stop, words) of the lines, by the plain rules, for texts without sentences of 50 words."""
    lines = []
    for line in re.finditer(r"[^\n]*(?:\n|$)", body):
        ends, words = [line.end()], len(line[0].split())
        if words >= 50:
            ends = [line.start() + m.end() for m in re.finditer(r"[.!?][\"')\]]*[ \t]+", line[0])] + ends
            ends = [e for e, nxt in zip(ends, ends[1:]) if len(body[e:nxt].split()) >= 4] + [line.end()]
        for a, b in zip([line.start(), *ends], ends):
            if body[a:b].strip(BLANKS):
                lines.append((a, a + len(body[a:b].rstrip(BLANKS)), len(body[a:b].split())))
    return lines


def plain_runs(body):
    """(start, stop, next) of all shortest runs that count."""
    lines = plain_lines(body)
    after = [a for a, _, _ in lines[1:]] + [len(body)]

    def counts(i, j):
        n = sum(n for _, _, n in lines[i : j + 1])
        return n >= 20 or (n >= 8 and j > i)

    found = set()
    for i in range(len(lines)):
        found.update([(i, next(j for j in range(i, len(lines)) if counts(i, j)))] if counts(i, len(lines) - 1) else [])
        found.update([(next(k for k in range(i, -1, -1) if counts(k, i)), i)] if counts(0, i) else [])
    return sorted((lines[i][0], lines[j][1], after[j]) for i, j in found)


BLANKS = " \t\n\r\v\f"


def test_line_chunks_against_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in sf("documents").collect() if r.text.isascii() and all(n < 50 for _, _, n in plain_lines(r.text))]
    rng = random.Random(3)
    blocks = ["\n".join(invented(rng, 11) for _ in range(10)), " ".join(invented(rng, 13) + "." for _ in range(4)), "\n".join(invented(rng, 18) for _ in range(3))]
    docs = [(d, t if d % 3 else t + "\n" * (d % 2 + 1) + blocks[d // 3 % 3] + "\n" + invented(rng, 9)) for d, t in sorted(docs)]
    assert len(docs) > 50
    first, count, want = {}, {}, {}
    for doc, body in docs:
        for a, b, _ in plain_runs(body):
            first.setdefault(body[a:b], (doc, a))
            count[body[a:b]] = count.get(body[a:b], 0) + 1
    for doc, body in docs:
        spans = [(a, c) for a, b, c in plain_runs(body) if first[body[a:b]] != (doc, a)]
        want[doc] = linechunks.cut(body.encode(), spans).decode() if spans else body
    got = {r.doc_id: r for r in linechunks.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    given = dict(docs)
    # what isn't grown from a chosen chunk may stay: a few short runs, and never a passage of 50 words
    assert sum(got[d].text != want[d] for d in want) <= 0.1 * len(docs)
    assert all(len(got[d].text.split()) - len(want[d].split()) < 50 for d in want)
    for d, text in want.items():
        assert len(text) <= len(got[d].text) <= len(given[d])
        assert (got[d].removed_chunks > 0) == (got[d].text != given[d])
    for k, block in enumerate(blocks):
        assert [d for d, r in sorted(got.items()) if block in r.text] == [min(d for d, t in docs if block in t)]
        assert all(block.split("\n")[0] not in r.text and block.split()[-1] not in r.text for d, r in got.items() if block in given[d] and block not in r.text)


def test_clashing_columns_and_unlike_bytes(spark, monkeypatch):
    same = "\n".join(f"alpha{k} beta{k} gamma{k} delta{k} epsilon{k}" for k in range(6))
    rows = [(k, same, f"s{k}", k, k, "r", 1.5, "w", 2) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, _key int, removed_chunks int, rest string, body double, `a.b` string, n_chars int")
    got = sorted(linechunks.dedup(docs).collect())
    assert linechunks.dedup(docs).columns == ["doc_id", "text", "spans", "_key", "rest", "body", "a.b", "n_chars", "removed_chunks"]
    assert [(r.text, r.spans, r.rest, r["a.b"], r.n_chars, r.removed_chunks) for r in got] == [(same, "s0", "r", "w", 2, 0), ("", "s1", "r", "w", 0, 1), ("", "s2", "r", "w", 0, 1)]


def test_boundaries_do_not_shift():
    rng = random.Random(21)
    passage = [invented(rng, 9) for _ in range(12)]
    found = []
    for lead in (0, 1, 2, 5):
        body = "\n".join([invented(rng, 9) for _ in range(lead)] + passage + [invented(rng, 9)])
        at = body.index(passage[0])
        found.append({(a - at, b - at) for a, b, _ in linechunks.chunks(body.encode()) if a >= body.index(passage[1]) and b <= body.index(passage[-1])})
    assert found[0] and all(f == found[0] for f in found)
    lines = sorted({a for a, _ in found[0]})
    assert len(lines) < 12 - 2  # not every line begins a chunk


def invented(rng, n):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n))


def test_passages_of_short_lines(spark):
    rng = random.Random(11)
    tabbed = "\n".join("\t".join(invented(rng, 10).split()) for _ in range(8))
    han = "。".join("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(14)) for _ in range(6)) + "。"
    for passage in ("\n".join(invented(rng, 10) for _ in range(8)), "\n\n".join(invented(rng, 3) for _ in range(20)), tabbed, han):
        rows = [(i, f"{invented(rng, 30)}.\n{passage}\n{invented(rng, 30)}.") for i in range(20)]
        got = {r.doc_id: r for r in linechunks.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        assert got[0].text == rows[0][1]
        for i, text in rows[1:]:
            assert got[i].text == text.replace(passage + "\n", "") and got[i].removed_chunks == 1


def test_runs_against_the_plain_rules():
    rng = random.Random(12)
    bodies = ["\n\n".join(" ".join(invented(rng, rng.randrange(1, 25)) + rng.choice([".", "!", '."', ""]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(1, 6))) + rng.choice(["", "\n", " \n "]) for _ in range(200)]
    bodies = [b for b in bodies if all(n < 50 for _, _, n in plain_lines(b))]
    r = linechunks.runs([b.encode() for b in bodies])
    for k, body in enumerate(bodies):
        mine = r.text == k
        assert list(zip(r.start[mine].tolist(), r.stop[mine].tolist(), r.next[mine].tolist())) == plain_runs(body)


def test_passages_within_paragraphs_and_unmarked_text(spark):
    rng = random.Random(13)
    kept = total = 0
    for marked in (True, False):
        dot = "." if marked else ""
        rows, passages = [], []
        for i in range(30):
            passages.append(" ".join(invented(rng, 12) + dot for _ in range(5)))
            for k in range(2):
                rows.append((2 * i + k, f"{invented(rng, 120)}{dot} {passages[-1]} {invented(rng, 120)}{dot}"))
        got = {r.doc_id: r.text for r in linechunks.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        for i, passage in enumerate(passages):
            assert got[2 * i] == rows[2 * i][1]
            if marked:
                assert got[2 * i + 1] == rows[2 * i + 1][1].replace(passage + " ", "")
            else:  # words at the passage's ends stay, and nothing else is lost
                left = got[2 * i + 1].split()
                assert not set(rows[2 * i + 1][1].split()) - set(passage.split()) - set(left)
                kept, total = kept + len(left) - 240, total + 60
    assert kept < 0.25 * total


@pytest.fixture(scope="module")
def family():
    """500 texts of a template of 200 words with 40 words of their own, and copies of 40 of them at a Jaccard of 0.86 or so."""
    rng = random.Random(14)
    common = [f"c{k}" for k in range(200)]
    texts = [[f"w{rng.randrange(10**6)}" for _ in range(20)] + common + [f"w{rng.randrange(10**6)}" for _ in range(20)] for _ in range(500)]
    for k in range(40):
        copy = list(texts[k])
        for at in (5, 60 + 3 * k, 235):
            copy[at] = f"x{k}"
        texts.append(copy)
    return [" ".join(t) for t in texts]


@pytest.mark.parametrize("block", [6, 2000])
def test_prefix_pairs_against_brute_force(spark, family, block):
    rng = random.Random(15)
    texts = family[:60] + family[500:] + [" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 60))) for _ in range(120)]
    texts = sorted(set(texts))
    sets = [set(simhash.shingles(t.encode(), 5)) for t in texts]
    assert [len(x) for x in simhash.shingle_sets([t.encode() for t in texts], 5)] == list(map(len, sets))
    frame = spark.createDataFrame([(k, t.encode()) for k, t in enumerate(texts)], "node long, body binary")
    none = spark.createDataFrame([], "node long, root long")
    shared = simhash.shared_keys(simhash.marks(frame, 5, 0.8))
    got = {(r.a, r.b) for r in simhash.prefix_pairs(shared, none, 0.8, block).collect()}
    want = {(i, j) for j in range(len(texts)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    assert len(want) >= 40 and want <= got
    linked = spark.createDataFrame([(j, i) for i, j in want] + [(i, i) for i, _ in want], "node long, root long").dropDuplicates(["node"])
    assert simhash.prefix_pairs(shared, linked, 0.8).count() < len(got)


def test_near_duplicates_in_a_family_with_hot_keys(spark, family):
    docs = spark.createDataFrame(list(enumerate(family)), "doc_id long, text string")
    roots = {r.text_key: r.root for r in simhash.near_duplicates(docs).collect()}
    keys = {r.doc_id: r.k for r in docs.select("doc_id", simhash.text_key().alias("k")).collect()}
    assert all(roots[keys[k]] == roots[keys[500 + k]] for k in range(40))
    assert len({roots.get(keys[k], keys[k]) for k in range(500)}) == 500


def test_no_link_is_lost_at_any_similarity(spark):
    rng = random.Random(16)
    rows, similar = [], {}
    for k in range(900):  # pairs from just under 0.8 up to 1, of 12 to 300 words
        n = rng.choice([12, 40, 120, 300, 300, 300, 300])
        one = [f"w{rng.randrange(10**7)}" for _ in range(n)]
        two = list(one)
        for at in rng.sample(range(n), rng.randrange(1, max(2, n // 40 + 1))):
            two[at] = "x" + two[at]
        a, b = (set(simhash.shingles(" ".join(t).encode(), 5)) for t in (one, two))
        similar[k] = len(a & b) / len(a | b)
        rows += [(2 * k, " ".join(one)), (2 * k + 1, " ".join(two))]
    kept = {r.doc_id for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for low in (0.8, 0.85, 0.9, 0.95):
        assert sum(low <= s < low + 0.05 for s in similar.values()) >= 40
    assert {k for k, s in similar.items() if s >= 0.8} == {k for k in similar if 2 * k + 1 not in kept}
    assert all(2 * k in kept for k in similar)
