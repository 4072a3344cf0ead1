"""The text engine's functions that no query shows: files, rules, runs and odd rows."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quillspark.functions import text as T
from quillspark.operators import acronyms, analytics, annotate, enrich, filters, gazetteer, link, linking, places, recognise, sampling, spans, vocabulary
from quillspark.plans import domains, run
from quillspark.sources import files, records, turtle
from quillspark.streaming import incremental

MENTIONS = "section_id string, start int, end int, text string, entity string, model string, score double"


def vocab(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "id string, concept string, synonyms string, type string, freq long, ord int")


@pytest.mark.parametrize("most", [1, 2, 3, 100])
def test_slices_of_a_dictionary_find_what_one_finds(spark, most):
    rng = random.Random(most)
    words = "a b c d e".split()
    for _ in range(2):
        terms = [(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))), f"T{i}", f"c{i}", "X", i) for i in range(6)] + [("A B", "AC", "ac", "X", 9)]
        texts = [(str(k), " ".join(rng.choice([*words, "A", "B", "-", "f"]) for _ in range(30))) for k in range(6)] + [("e", ""), ("n", None)]
        frame = spark.createDataFrame(terms, "term string, id string, concept string, type string, at int")
        sections = spark.createDataFrame(texts, "section_id string, text string")
        got = sorted((r.section_id, r.start, r.end, r.linked_id) for r in gazetteer.match(sections, frame, most_terms=most).collect())
        one = gazetteer.Matcher([t[:4] for t in terms])
        assert got == sorted((k, a, b, m[1]) for k, t in texts if t for a, b, m, good in one.find(t) if good)
    # one dictionary against plain rules: from the left, the longest, and nothing within words
    assert [(a, b) for a, b, _, _ in gazetteer.Matcher([("ab cd", "1", "x", "y"), ("cd", "2", "x", "y")]).find("xab cd ab  cd AB CD")] == [(4, 6), (11, 13), (14, 19)]


def test_overlaps_against_brute_force(spark):
    rng = random.Random(4)
    rows = lambda n, m: [(rng.choice(["s", "t", None]), a := rng.randrange(200), a + rng.randrange(1, 9), str(k), "e", m, 1.0) for k in range(n)]
    ours, kept = rows(150, "m"), rows(40, "g")
    got = spans.without_overlaps(spark.createDataFrame(ours, MENTIONS), spark.createDataFrame(kept, MENTIONS)).collect()
    want = [r for r in ours if not any(r[0] is not None and r[0] == g[0] and r[1] < g[2] and r[2] > g[1] for g in kept)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    merged = spans.merge_sources(spark.createDataFrame(kept, MENTIONS), spark.createDataFrame(ours, MENTIONS))
    assert merged.count() == len(want) + len(kept)
    empty = spark.createDataFrame([], MENTIONS)
    assert spans.without_overlaps(empty, empty).count() == 0 and spans.merge_adjacent(empty).count() == 0


def test_overlaps_of_a_section_are_one_running_sweep(spark):
    """No frame runs to the end of the section: Spark computes such a frame anew for every row."""
    rows = spark.createDataFrame([("s", 0, 4, "a", "e", "m", 1.0), ("s", 4, 6, "b", "e", "m", 1.0), ("s", 8, None, "c", "e", "m", 1.0)], MENTIONS)
    kept = spark.createDataFrame([("s", 4, 5, "g", "e", "g", 1.0), ("s", None, 99, "n", "e", "g", 1.0)], MENTIONS)
    got = spans.without_overlaps(rows, kept)
    assert sorted(r.text for r in got.collect()) == ["a", "c"]
    assert "unboundedfollowing" not in got._jdf.queryExecution().toString().lower()


def test_turtle_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    name = "Journal of X::ab12::cd34.ttl"
    (tmp_path / "in" / name).write_text(
        "@prefix nif: <http://persistence.uni-leipzig.org/nlp2rdf/ontologies/nif-core#> .\n"
        '<http://d/1#s1> a nif:Section ; nif:anchorOf """  Wind (W) "power".  """ .\n'
        '<http://d/1#s2> nif:anchorOf "" .\n'
        '<http://d/1> nif:isString "Short." , "The longest \\"text\\"." .\n'
        '<http://d/1#a1> <http://x/affRawAffiliationString> "Dep. A\\n\\tCity ,  Land ;" .\n',
        encoding="utf-8",
    )
    (tmp_path / "broken.ttl").write_text("<http://d/9> nif:anchorOf")
    triples = turtle.read_triples(spark, str(tmp_path))
    assert triples.where("p LIKE '%anchorOf'").count() == 2 and triples.where("error is not null").count() == 1
    assert [r.fulltext for r in turtle.documents(triples).collect()] == ['The longest "text".']
    assert [r.raw_affiliation for r in turtle.affiliations(triples).collect()] == ["Dep. A, City, Land"]
    found = turtle.sections(triples).collect()
    assert len(found) == 1 and found[0].section_content.strip() == 'Wind (W) "power".' and (found[0].journal, found[0].id1, found[0].id2) == ("Journal of X", "ab12", "cd34")


def test_json_records_and_sinks(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"oaireid": "1", "titles": ["A  title"], "abstracts": ["Text."]}, {"oaireid": null, "titles": ["x"]}]')
    (tmp_path / "b.json").write_text('{"oaireid": "2", "titles": ["Only?"]}\n\nnot json\n{"oaireid": "3", "titles": [" "], "abstracts": []}\n')
    schema = "oaireid string, titles array<string>, abstracts array<string>"
    rows = records.title_abstract_sections(records.json_records(spark, str(tmp_path), schema))
    assert sorted((r.section_id, r.section_content_expanded, r.section_type) for r in rows.collect()) == [("1", "A title. Text.", "title_abstract"), ("2", "Only?", "title")]


def test_language_markers_and_rules(spark):
    said = {"the cat is here with that dog": "en", "el gato es de la casa que": "es", "le chat est dans la rue pour": "fr", "der hund und die katze ist": "de", "short": "unknown", None: "unknown", "xxxxxxxxxxxxxxxxxxxxxxxxx": "unknown", "هذا نص طويل بما يكفي للاختبار": "ar", "这是一个足够长的测试文本用于语言检测功能的": "zh"}
    rows = spark.createDataFrame([(k,) for k in said], "t string").select("t", T.language(F.col("t")).alias("l")).collect()
    assert {r.t: r.l for r in rows} == said
    pairs = [("ECU", "electronic control unit", True), ("RAS", "renewable or alternative sources", True), ("RORS", "renewable or real sources", False), ("X", "", False), ("12", "some words", True)]
    got = spark.createDataFrame(pairs, "a string, b string, w boolean").select("w", T.initials_match(F.col("a"), F.col("b")).alias("g")).collect()
    assert all(r.w == r.g for r in got) and all(acronyms.agrees(a, b) == w for a, b, w in pairs)


def test_acronyms(spark):
    text = "Gross domestic product (GDP) grew. Wind Energy ( WE ) too; the GDP and WE of 5 (five)."
    assert acronyms.acronym_map(text) == [("GDP", "Gross domestic product"), ("WE", "Wind Energy")]
    docs = spark.createDataFrame([("f", "second (S)", 2), ("f", text, 1), ("g", None, 1)], "file_path string, fulltext string, ord int")
    sections = spark.createDataFrame([("f", "GDP of WEs"), ("g", "GDP"), ("h", "GDP"), ("f", None)], "file_path string, section_content string")
    got = {(r.file_path, r.section_content): r.section_content_expanded for r in acronyms.expand_sections(sections, docs).collect()}
    assert got == {("f", "GDP of WEs"): "Gross domestic product of WEs", ("g", "GDP"): "GDP", ("h", "GDP"): "GDP", ("f", None): None}


def test_pieces_tags_and_wrapping():
    text = "uses wind-power (solar farms)"
    tokens = [("Ġwind", "B-E", 5, 9, 1), ("-", "I-E", 9, 10, 2), ("power", "I-E", 10, 15, 3), ("solar", "B-E", 17, 22, 5), ("Ġfarms", "I-E", 23, 28, 6)]
    made = recognise.tagged_words([{"word": w, "entity": e, "score": 0.5, "start": a, "end": b, "index": i} for w, e, a, b, i in tokens], text)
    assert [(m["word"], m["entity"]) for m in made] == [("wind-power", "E"), ("solar farms", "E")]
    assert [recognise.plausible(w) for w in ("above", "x", "45.8", "--", "wind")] == [False, False, False, False, True]
    assert recognise.balance(16, 22, text) == (16, 22) and recognise.balance(6, 16, "a (b c) d e (f)") == (6, 16) and recognise.balance(2, 6, "a (b c) d") == (2, 7)
    wrapped, shift = recognise.wrapped("a gene")
    assert recognise.unwrapped([{"word": "ge", "entity": "Gene", "start": 2 + shift, "end": 4 + shift}, {"word": "##ne", "entity": "Gene", "start": 4 + shift, "end": 6 + shift}, {"word": "a", "entity": "O-x", "start": shift, "end": 1 + shift}], "a gene", shift)[0]["word"] == "gene" and wrapped == "<ALL>a gene</ALL>"


def test_several_models(spark):
    sections = spark.createDataFrame([("s", "wind power and solar wind"), ("e", ""), ("n", None)], "section_id string, text string")
    one = recognise.DictionaryProvider({"wind": "E", "power": "E"}, "one")
    two = recognise.DictionaryProvider({"solar": "E"}, "two", 0.4)
    got = sorted((r.start, r.end, r.text, r.model) for r in recognise.predict_all(sections, [one, two]).collect())
    assert got == [(0, 10, "wind power", "one"), (15, 20, "solar", "two"), (21, 25, "wind", "one")]
    assert recognise.predict_all(sections, [one, two], threshold=0.5).count() == 2


def test_linking_run_with_fallback_and_pass_through(spark):
    v = vocab(spark, [("1", "wind turbine", "turbines", "e", 5), ("2", "solar panel", "", "e", 1)])
    rows = [("s", 0, 4, "turbine", "E"), ("s", 5, 9, "zz wind turbine zz", "E"), ("s", 5, 9, "nothing", "E"), ("none", 0, 1, "turbines", "E"), ("empty", 0, 1, "turbines", "E"), ("s", 9, 12, "x", "Other"), ("s", 1, 2, None, "E"), ("s", 1, 2, "turbines", None), ("s", 1, 2, "aa", "E")]
    mentions = spark.createDataFrame([(*r, "old" if r[3] == "aa" else None) for r in rows], "section_id string, start int, end int, text string, entity string, linked_id string")
    sections = spark.createDataFrame([("s", "a wind turbine"), ("empty", "")], "section_id string, text string")
    linkers = {"e": domains.Linker("v", "SRC", "semantic")}
    got = {(r.section_id, r.text, r.entity): r.linked_id for r in linking.link_by_type(mentions, sections, {"v": v}, linkers, embedder=linking.HashEmbedder(), threshold=0.7).collect()}
    assert len(got) == len(rows)
    assert got["s", "turbine", "E"] == "1" and got["s", "aa", "E"] == "old"
    assert got["s", "nothing", "E"] == "1"  # by the section's text
    assert all(got[k] is None for k in [("none", "turbines", "E"), ("empty", "turbines", "E"), ("s", "x", "Other"), ("s", None, "E"), ("s", "turbines", None)])
    none = linking.link_by_type(mentions.where("false"), sections, {"v": v}, linkers)
    assert none.count() == 0
    top = linking.semantic_links(mentions.where("text = 'nothing'").withColumn("section", F.lit("a nothing")), v, linking.HashEmbedder(), 0.0)
    assert top.count() == 1


def test_reranking_drops_mentions_that_their_section_lacks(spark):
    mentions = spark.createDataFrame([("s", 0, 4, "Wind", "E"), ("s", 5, 9, "water", "E"), ("t", 0, 1, "wind", "E")], "section_id string, start int, end int, text string, entity string")
    sections = spark.createDataFrame([("s", "the wind blows")], "section_id string, text string")
    candidates = spark.createDataFrame([("wind", "1", 0.9, 1), ("wind", "2", 0.8, 2)], "query string, entry string, score double, rank int")
    names = spark.createDataFrame([("1", "wind power"), ("2", "wind speed")], "entry string, name string")
    got = sorted((r.section_id, r.text, r.linked_id) for r in linking.rerank_sections(mentions, sections, candidates, names, linking.FirstCandidate()).collect())
    assert got == [("s", "Wind", "1"), ("t", "wind", None)]
    assert linking.rerank_sections(mentions, sections, candidates, names, linking.FirstCandidate(), threshold=0.95).where("linked_id is not null").count() == 0
    queries = spark.createDataFrame([("w", ["a", "b"]), ("v", [])], "m string, c array<string>").select(linking.instruct_query("Link", F.col("m"), F.col("c")).alias("q")).collect()
    assert [r.q for r in queries] == ["Instruct: Link\nQuery: w\nExample occurrences:\n- a\n- b", "Instruct: Link\nQuery: v"]


def test_resolving_a_run():
    d = domains.Domain("x", el_config={"threshold": 0.7, "el_model_name": "some-instruct-model"}, linkers={"Gene": domains.Linker("g", "G", blocked=frozenset({"CAT"}))}, blocked={"dog"}, min_length={"Gene": 3})
    assert (domains.resolve(d).linker, domains.resolve(d).threshold, domains.resolve(d, threshold=0.9).threshold) == ("instruct", 0.7, 0.9)
    assert domains.resolve(d, reranker_llm="Qwen-like").linker == "reranker" and domains.resolve(d, linker_type="semantic").linker == "semantic"
    assert domains.resolve(domains.Domain("y")).linker == "semantic"
    assert d.mention_filter().blocked == {"_all": {"dog"}, "gene": {"cat"}}
    with pytest.raises(ValueError):
        domains.resolve(d, treshold=1)


def test_lookups_of_several_vocabularies(spark):
    a, b = vocab(spark, [("1", "One", "uno", "t", 1)]), vocab(spark, [("2", "Two", "", "t", 1)]).withColumn("variants", F.lit("deux|zwei"))
    made = domains.build_lookups({"a": a, "b": b, "c": None}, {"b": ("variants", "absent")})
    assert {(r.vocabulary, r.key) for r in made.collect()} == {("a", "one"), ("a", "uno"), ("b", "two"), ("b", "deux"), ("b", "zwei")}
    assert {tuple(r) for r in domains.sample_files(spark, ["/x/energy-all-ft/s.tsv", "/x/y/cancer_2.tsv"]).collect()} == {("energy", "/x/energy-all-ft/s.tsv"), ("cancer", "/x/y/cancer_2.tsv")}
    assert [tuple(r) for r in domains.vocabulary_files(spark, ["/v/energy/a.tsv", "/v/energy/a_enriched.tsv"]).collect()] == [("energy", "/v/energy/a.tsv")]


def scan(rows, n_linked, n_unlinked, per):
    taken, seen, counts, room = [], set(), {}, {True: n_linked, False: n_unlinked}
    for r in sorted(rows, key=lambda r: (r[3], r[0])):
        if not any(room.values()):
            break
        if r[0] in seen or counts.get(r[1].lower(), 0) >= per or not room[r[2]]:
            continue
        seen.add(r[0])
        counts[r[1].lower()] = counts.get(r[1].lower(), 0) + 1
        room[r[2]] -= 1
        taken.append(r[0])
    return taken


@pytest.mark.parametrize("limits", [(5, 3), (0, 4), (100, 2), (100, 100), (3, 0)])
def test_sequential_sampler_against_a_scan(spark, limits):
    rng = random.Random(sum(limits))
    rows = [(f"i{k}", rng.choice(["A", "a", "b", "c", "d"]) + rng.choice("12"), rng.random() < 0.6, k) for k in range(60)]
    frame = spark.createDataFrame(rows, "id string, mention string, is_linked boolean, at int")
    got = sorted(r.id for r in annotate.sequential(frame, ["at"], *limits, per_mention=2).collect())
    assert got == sorted(scan(rows, *limits, 2))


def test_contexts_and_type_checks(spark):
    text = "One is short. The wind turbine stands! And so on"
    rows = spark.createDataFrame([(text, 18, 30), (text, 5, 20), (text, 39, 42), ("", 0, 0)], "t string, a int, b int")
    got = [r.c for r in rows.select(annotate.sentence_at(F.col("t"), F.col("a"), F.col("b"), 3).alias("c")).collect()]
    assert got == ["The wind turbine stands!", text[2:23].strip(), "And so on", ""]
    maps = {"d": {"Store": ["storage"]}, "e": {"Gene": ["gene", "protein"]}}
    check = annotate.type_check(F.col("a"), F.col("b"), maps, "d", {"Vehicle": ["vehicle types"]}, annotate.KEYWORDS)
    cases = [("Storage", "Store", "yes"), ("protein", "Gene", "yes"), ("x", "Gene", "no"), ("vehicle types", "Vehicle|Q", "yes"), ("sensor types", "some sensor", "yes"), ("plain", "Plain", "yes"), ("", "Gene", "na"), ("x", None, "na")]
    assert all(r.g == r.w for r in spark.createDataFrame(cases, "a string, b string, w string").select("w", check.alias("g")).collect())
    assert annotate.of_type(rows.withColumn("entity", F.lit("Gene")), "gENE").count() == 4
    link_rows = spark.createDataFrame([([("1", 0.5), ("2", 0.7)], "2"), ([("1", 0.5)], "9"), ([], "1"), (None, "1")], "l array<struct<id:string,score:double>>, i string")
    assert [r.s for r in link_rows.select(annotate.link_score(F.col("l"), F.col("i")).alias("s")).collect()] == [0.7, 0.5, None, None]


class Places:
    name = "places"

    def predict(self, texts):
        return [[(i, i + len(w), "geo", 0.8) for w in ("Spain", "western Europe", "US", "Qq", "Madrid") if (i := t.find(w)) >= 0] for t in texts]


def test_places_chain(spark):
    sections = spark.createDataFrame([("s", "We studied Spain, Spain and Madrid. Work near western Europe and US or Qq was done."), ("e", ""), ("n", None)], "section_id string, text string")
    roles = places.KeywordRoles({"studied": "Object of study", "near": "Location of research"})
    tagged = places.geotagged(sections, Places(), roles)
    assert {r.section_id: len(r.entities) for r in tagged.collect()} == {"s": 5, "e": 0, "n": 0}
    osm = "struct<class:string,importance:double,place_rank:int>"
    table = spark.createDataFrame([("spain", ("boundary", 0.9, 4)), ("europe", ("place", 0.8, 2)), ("us", ("boundary", 0.9, 4)), ("madrid", ("waterway", 0.9, 4))], f"name string, osm {osm}")
    demonyms = spark.createDataFrame([("Spanish", "Spain")], "form string, country string")
    made = places.linked_places(tagged.withColumn("source_file", F.lit("f")).withColumn("line", F.lit(1)), demonyms, table).collect()
    assert [e.normalized_text for e in made[0].entities] == ["Spain", "Europe", "US"] and len(made) == 1
    marks = spark.createDataFrame([("in Spain now", "Spain"), ("none", "x")], "c string, m string").select(places.marked_context(F.col("c"), F.col("m")).alias("r")).collect()
    assert [r.r for r in marks] == ["in [START] Spain [END] now", "none"]


class Resolver:
    def resolve(self, raw):
        if "bad" in raw:
            raise ValueError
        return [{"name": x, "n": 1} for x in raw]


def test_enrichment(spark):
    client = enrich.TableClient([{"qid": "Q1", "label": "Wind", "aliases": ["air flow"]}, {"qid": "Q2", "label": "wind", "aliases": []}])
    v = spark.createDataFrame([("1", "wind", "", ""), ("2", "sun", "Q5", "star"), ("3", None, None, None)], "id string, concept string, wikidata_id string, wikidata_aliases string")
    found = enrich.found_candidates(v, client)
    assert sorted(map(tuple, found.collect())) == [("1", "Q1", "Wind", 1), ("1", "Q2", "wind", 2)]
    entities = spark.createDataFrame([("Q1", "Wind", ["air flow", "sun", "Breeze"])], "qid string, label string, aliases array<string>")
    made = {r.id: (r.wikidata_id, r.wikidata_aliases) for r in enrich.enrich(v, entities, found.where("rank = 1").select("id", "qid"), exclude=("breeze",)).collect()}
    assert made == {"1": ("Q1", "air flow"), "2": ("Q5", "star"), "3": ("", "")}
    titles = spark.createDataFrame([("1", 1, "none"), ("1", 2, "Wind"), ("2", 1, "x")], "id string, rank int, title string")
    assert [tuple(r) for r in enrich.first_title(titles, spark.createDataFrame([("Wind", "Q1")], "title string, qid string")).collect()] == [("1", "Q1")]

    rows = spark.createDataFrame([(str(k), x) for k, x in enumerate(["ü a", "bad", "c"])], "affiliation_id string, raw_affiliation string").coalesce(1)
    assert [(r.affiliation_id, json.loads(r.result)["name"]) for r in enrich.resolved_affiliations(rows, Resolver(), 1).collect()] == [("0", "ü a"), ("2", "c")]


def test_files_and_pairs(spark, tmp_path):
    path = str(tmp_path / "x" / "a.json")
    assert files.load_json(path, []) == []
    files.save_json(path, {"a": "é"})
    assert files.load_json(path) == {"a": "é"}
    files.append_json_line(path + "l", [1])
    files.append_json_line(path + "l", [2])
    assert [json.loads(x) for x in open(path + "l")] == [[1], [2]]
    assert len(files.logger("test-engine").handlers) == len(files.logger("test-engine").handlers) == 1
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "path string")
    assert [tuple(r) for r in files.pairs(names("/a/d1_sections.csv", "/a/d2_sections.csv"), names("/b/d1.jsonl", "/b/d3.jsonl")).collect()] == [("d1", "/a/d1_sections.csv", "/b/d1.jsonl")]
    rows = spark.createDataFrame([("s", "text", "t", "p")], files.SECTIONS)
    files.save_sections(rows, str(tmp_path / "cache"))
    files.save_sections(rows.unionByName(rows), str(tmp_path / "cache"))
    assert files.load_sections(spark, str(tmp_path / "cache")).count() == 1
    (tmp_path / "c.csv").write_text("section_id,section_content_expanded,section_type,paper_path\n1,\"two\nlines\",t,p\n")
    assert [r.section_content_expanded for r in files.load_sections(spark, str(tmp_path / "c.csv")).collect()] == ["two\nlines"]


def test_vectors_in_slices(spark):
    rng = random.Random(9)
    rows = [(k, [rng.random() for _ in range(5)]) for k in range(40)]
    e = spark.createDataFrame(rows, "entry long, vector array<double>")
    q = e.where("entry < 4").withColumnRenamed("entry", "query")
    whole, sliced = (sorted(map(tuple, link.top_k(q, e, 3, most_bytes=b).collect())) for b in (1 << 20, 300))
    want = [(i, j, round(sum(x * y for x, y in zip(rows[i][1], rows[j][1])), 6)) for i in range(4) for j in range(40)]
    assert whole == sliced and {(a, b, c) for a, b, c, _ in whole} == {x for i in range(4) for x in sorted((w for w in want if w[0] == i), key=lambda w: (-w[2], w[1]))[:3]}


def test_nearest_vectors_against_brute_force(spark):
    """Ties, nulls, other lengths and repeated ids; no pair of query and entry is a row of a join."""
    rng = random.Random(5)
    rows = [(k // 2 * 2 if k % 50 == 1 else k, [rng.randrange(-4, 5) / 4 for _ in range(3)], k % 3) for k in range(300)]
    rows += [(300, None, 0), (301, [1.0, None, 2.0], 1), (302, [1.0], 2), (303, [float("nan"), 1.0, 1.0], 0), (304, [0.0, 0.0, 0.0], None)]
    e = spark.createDataFrame(rows, "entry long, vector array<double>, g int")
    q = e.where("entry % 10 = 4 and entry < 300").withColumnRenamed("entry", "query")
    pairs = link._scored(q, e, 2)
    want = sorted(map(tuple, pairs.withColumn("rank", F.row_number().over(link.Window.partitionBy("query").orderBy(F.desc("score"), "entry"))).where("rank <= 4").collect()), key=repr)
    for b in (1 << 20, 700):
        top = link.top_k(q, e, 4, 2, most_bytes=b)
        assert sorted(map(repr, map(tuple, top.collect()))) == list(map(repr, want))
    assert not any(x in top._jdf.queryExecution().toString() for x in ("NestedLoop", "CartesianProduct"))
    few = spark.createDataFrame([(1, None), (2, [1.0]), (3, None)], "entry long, vector array<double>")
    assert [(r.entry, r.score) for r in link.top_k(few.where("entry = 2").withColumnRenamed("entry", "query"), few, 2).orderBy("rank").collect()] == [(2, 1.0), (1, None)]
    clean = e.where("entry < 300").withColumnRenamed("entry", "qid")
    ours = q.withColumnRenamed("query", "id")
    found = ours.select("id", "g").distinct().join(clean, "g").where("id <> qid").drop("g")
    slow = enrich.most_similar(ours.select("id", "vector"), found, 0.3, 2)
    fast = enrich.most_similar_within(ours, clean, "g", 0.3, 2)
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect())) != []


def test_equal_spans_are_matched_once(spark):
    """Copies of a span don't multiply: the join sees each (section, span, text) once."""
    rows = spark.createDataFrame([(f"k{i}", "s", 0, 4, "Wind" if i % 2 else "wind") for i in range(200)] + [("d", "s", 9, 11, "x"), ("d", "s", 1, 4, "WIND"), (None, "s", 0, 4, "wind")], "sample_id string, section_id string, start int, end int, text string")
    mentions = spark.createDataFrame([("s", 0, 4, "Wind" if i % 2 else "wind", "E", "m", i / 8) for i in range(200)], MENTIONS)
    made = spans.match_mentions(rows, mentions)
    got = {(r.sample_id, r.start): (r.tier, r.m_start, r.m_score) for r in made.collect()}
    assert len(got) == 203 and got["k7", 0] == (1, 0, 0.125) and got["d", 9] == got["d", 1] == (2, 0, 0.125) and got[None, 0] == (None, None, None)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("_low") and "min(struct(m_text" in plan


def test_batches_are_matched_in_slices():
    import pyarrow as pa

    batch = pa.record_batch({"section_id": [str(k) for k in range(7)], "text": ["a" * 40, None, "b" * 300, "", "c" * 90, "d" * 20, "e"]})
    parts = list(gazetteer._slices(iter([batch, batch.slice(0, 0)]), 100))
    assert [p.num_rows for p in parts] == [2, 1, 2, 2] and pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()


def test_entries_of_one_concept_join_once(spark):
    rows = [(str(i), "blue ring" if i % 2 else "Blue Ring", i) for i in range(400)] + [("z", "ringing", 999)]
    vocab = spark.createDataFrame(rows, "id string, concept string, ord int")
    terms = spark.createDataFrame([("a ring", 1), ("ringing", 1), ("nought", 1)], "term string, n int")
    made = analytics.candidates(terms, vocab)
    assert [r.id for r in made.where("term = 'a ring'").orderBy("rank").collect()] == list("01234") and [r.id for r in made.where("term = 'ringing'").collect()] == ["z"]
    assert made._jdf.queryExecution().optimizedPlan().toString().count("WindowGroupLimit") == 3  # by concept, keyword and term
    assert {r.term: r["class"] for r in analytics.classify_unlinked(terms, vocab).collect()} == {"a ring": "SYNONYM", "ringing": "SYNONYM", "nought": "UNKNOWN"}


def test_samples_and_reports(spark):
    rows = [(f"k{i}", rng, f"t{i % 7}", "x" if i % 3 else None) for i, rng in enumerate("aabbbbccccccccc" * 4)]
    frame = spark.createDataFrame(rows, "k string, g string, text string, linked_id string")
    got = sampling.stratified(frame, "g", "k", 12).collect()
    assert len({r.k for r in got}) == 12 and {g: sum(r.g == g for r in got) for g in "abc"} == {"a": 4, "b": 4, "c": 4}
    assert sampling.with_unlinked(frame, "k", 10, 0.2).where("linked_id is null").count() == 2
    top = annotate.two_level(frame, "g", "k", 9, per_mention=1, text="text").collect()
    assert len(top) == 9 and len({(r.g, r.text) for r in top}) == 9
    counts = spark.createDataFrame([("d1", "m", 5), ("d2", "m", 9), ("d1", "n", 1), ("d3", "n", 7)], "doc_id string, model string, n int")
    assert {r.doc_id for r in sampling.balanced_files(counts, 2).collect()} == {"d2", "d3"}
    assert sampling.weighted_files(spark.createDataFrame([(str(k), k) for k in range(9)], "path string, size int"), 4).count() == 4
    assert sampling.statistics(frame, "g").count() == 3
    watched, seen = analytics.observed(frame, "w", linked=F.col("linked_id").isNotNull())
    watched.count()
    assert seen.get == {"rows": 60, "linked": 40}
    assert filters.valid_place("o") is not None
    osm = spark.createDataFrame([(("waterway", 0.9, 4),), (("tourism", 0.9, 4),), (("place", 0.1, 4),), (("place", 0.9, 26),), ((None, None, None),)], "o struct<class:string,importance:double,place_rank:int>")
    assert [r.v for r in osm.select(filters.valid_place("o").alias("v")).collect()] == [False, True, False, False, False]


def test_vocabulary_parts(spark):
    v = vocab(spark, [("1", "wind power", "air", "E", 3), ("2", "solar", "", "E", 9), ("1", "later", "breeze", "E", 1), (None, "x", "", "", 0)])
    assert {(r.query, r.id) for r in vocabulary.search(v, spark.createDataFrame([("power wind",), ("nothing",)], "query string")).collect()} == {("power wind", "1")}
    assert {r.key for r in vocabulary.lookup(v).collect()} == {"wind power", "solar", "air", "breeze"}


def test_steps_resume_and_rerun(spark, tmp_path):
    out, manifest = str(tmp_path / "out"), str(tmp_path / "manifest")
    docs = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "section_id string, v int")
    twice = lambda d: d.where("v < 3").unionByName(d.where("v < 3"))
    assert run.pending(docs, docs.where("section_id = 'a'"), "section_id").count() == 2
    got = run.run_step("gaz", docs.where("v < 2"), twice, out, manifest)
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("a", 1)]  # equal rows stay

    def broken(d):
        twice(d).write.mode("overwrite").parquet(f"{out}/run=1")  # what a run leaves that fails before its entry
        raise RuntimeError

    with pytest.raises(RuntimeError):
        run.run_step("gaz", docs, broken, out, manifest)
    got = run.run_step("gaz", docs, twice, out, manifest)
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("a", 1), ("b", 2), ("b", 2)]
    entries = {(r.key, r.status) for r in run.read_manifest(spark, manifest).collect()}
    assert entries == {("a", "done"), ("b", "done"), ("c", "no_entities")}
    again = run.run_step("gaz", docs, lambda d: d, out, manifest, resume=False)
    assert sorted(map(tuple, again.collect())) == [("a", 1), ("b", 2), ("c", 3)]
    with pytest.raises(ValueError):
        run.run_step("none", docs, twice, out, manifest)


def test_directories_of_records(spark, tmp_path):
    for name, text in {"Energy_1.json": '[{"rsNr": "1", "en_lawText": "a b"}]', "energy_2.jsonl": '{"rsNr": "2", "en_lawText": "c"}\n{broken\n', "other.json": '{"rsNr": "3", "en_lawText": "d"}', "energy_bad.json": '[{"rsNr": ', "x.txt": "{}"}.items():
        (tmp_path / name).write_text(text)
    read = lambda **k: sorted((r.rsNr, r.source_file) for r in records.directory(spark, str(tmp_path), records.LEGAL, **k).collect() if r.rsNr)
    assert read() == [("1", "Energy_1.json"), ("2", "energy_2.jsonl"), ("3", "other.json")]
    assert read(domain="energy") == [("1", "Energy_1.json"), ("2", "energy_2.jsonl")] and read(part="_2") == [("2", "energy_2.jsonl")]
    found = records.directory(spark, str(tmp_path), records.LEGAL).where("rsNr is not null")
    made = records.legal_sections(found).join(found.select("rsNr", "source_file"), "rsNr")
    assert {(r.source_file, r.records, r.sections, r.max_length) for r in records.file_counts(found, made).collect()} == {("Energy_1.json", 1, 1, 3), ("energy_2.jsonl", 1, 1, 1), ("other.json", 1, 1, 1)}


def test_entity_lines_round_trip(spark, tmp_path):
    mentions = spark.createDataFrame([("s", 5, 9, "wind", "E", "m", 0.5), ("s", 0, 4, "sun ", "E", "m", 0.9)], MENTIONS)
    lines = records.entity_lines(mentions, spark.createDataFrame([("s",), ("t",)], "section_id string"))
    assert {r.section_id: [e.start for e in r.entities] for r in lines.collect()} == {"s": [0, 5], "t": []}
    records.write_lines(lines, str(tmp_path / "e"))
    got = records.read_entities(spark, str(tmp_path / "e")).where("text is not null").select("section_id", "start", "end", "text", "entity", "model", "score")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, mentions.collect()))
    records.write_lines(lines.withColumn("source_file", F.lit("f")), str(tmp_path / "by"), by="source_file")
    assert (tmp_path / "by" / "source_file=f").is_dir()
    (tmp_path / "v.tsv").write_text('id\tconcept\tsynonyms\n1\t"quoted\t\n2\tb\tx|y\n')
    rows = sorted(tuple(r)[:3] for r in records.read_tsv(spark, str(tmp_path / "v.tsv")).collect())
    assert rows == [("1", '"quoted', ""), ("2", "b", "x|y")]
    frame = spark.createDataFrame([("", "b", None), (None, None, "c")], "section_content string, text string, content string")
    assert [r.t for r in frame.select(records.text_column(frame).alias("t")).collect()] == ["b", "c"]


def test_streams_take_new_files_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "section_id string, text string"
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"section_id": str(k), "text": "wind"}))
        stream = incremental.file_stream(spark, str(tmp_path / "in"), schema)
        incremental.run_incremental(stream, lambda d: d.withColumn("n", F.length("text")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.section_id, r.n) for r in got.collect()) == [("0", 4), ("1", 4)]


def test_converters_and_patches(spark):
    genes = spark.createDataFrame([("7", "TP53", "P53|LFS1", "tumor protein"), ("8", None, "x", "y"), ("9", "ABC", "", "abc")], "GeneID string, Symbol string, Synonyms string, Description string").selectExpr("*", "'t' AS Type_of_gene", "'o' AS Organism", "'1' AS Organism_ID")
    got = {r.id: (r.concept, r.synonyms) for r in vocabulary.gene_rows(genes).collect()}
    assert got == {"NCBI:7": ("TP53", "P53|LFS1|tumor protein"), "NCBI:9": ("ABC", "")}
    species = spark.createDataFrame([("9606", "human", "man", "1"), ("", "x", "", ""), ("5", None, "", "")], "id string, term string, synonyms string, parent_id string").selectExpr("*", "'r' AS rank", "'v' AS variants", "'3' AS freq")
    assert [(r.id, r.concept, r.parent_id) for r in vocabulary.species_rows(species).collect()] == [("NCBI:9606", "human", "NCBI:1")]
    diseases = spark.createDataFrame([("DOID:1", "a", "", "d"), ("2", "b", "long", "d"), (None, "c", "", "")], "id string, name string, description string, def string").selectExpr("*", "'' AS synonyms", "'' AS suggestions")
    assert [(r.id, r.concept, r.description) for r in vocabulary.disease_rows(diseases).collect()] == [("DOID:1", "a", "d"), ("DOID:2", "b", "long")]
    rows = spark.createDataFrame([("1", "old", 1), ("1", "second", 2), ("2", "x", 3)], "id string, synonyms string, ord int")
    made = vocabulary.patch(rows, spark.createDataFrame([("1", ["OLD", "new"]), ("5", ["q"])], "id string, add array<string>")).collect()
    assert sorted((r.ord, r.synonyms) for r in made) == [(1, "old|new"), (2, "second"), (3, "x")]


def test_engine_on_odd_tables(spark):
    """Nulls in every column, empty texts, repeated rows and empty tables go through without a crash."""
    rows = [(None, None, None, None, None, None, None), ("s", 0, 4, "wind", "E", "m", 0.5), ("s", 0, 4, "wind", "E", "m", 0.5), ("", 0, 0, "", "", "", 0.0)]
    for mentions in (spark.createDataFrame(rows, MENTIONS), spark.createDataFrame([], MENTIONS)):
        n = mentions.count()
        v = vocab(spark, [("1", "wind", "", "E", 1)]) if n else spark.createDataFrame([], "id string, concept string, synonyms string, type string, freq long, ord int")
        sections = mentions.select("section_id", "text")
        frames = [spans.merge_adjacent(mentions), spans.first_of_span(mentions, ["score"]), spans.merge_places(mentions), spans.merge_sources(mentions, mentions), spans.replace_gazetteer(mentions, mentions), filters.MentionFilter.of({"x"}, 2).stats(mentions, ["entity"]), link.exact(mentions, v), link.all_matches(mentions, v), link.first_uses(mentions, ["section_id", "start"]), recognise.chunks(sections, 4, 1), recognise.predict(sections, recognise.DictionaryProvider({"wind": "E"})), gazetteer.match(sections, vocabulary.gazetteer_terms(v)), linking.link_by_type(mentions, sections, {"v": v}, {"E": domains.Linker("v", "S")}), sampling.capped(mentions, "section_id"), sampling.stratified(mentions, "entity", "section_id", 3), analytics.inspect_offsets(mentions, sections.dropDuplicates()), vocabulary.lookup(v), vocabulary.token_index(v), annotate.samples(mentions.withColumn("linking", F.lit(None).cast("array<struct<source:string,id:string,name:string>>")).withColumn("source_file", F.lit("f")), sections.dropDuplicates())]
        for frame in frames:
            frame.collect()
        assert link.exact(mentions, v).count() == n


def test_sentence_contexts_and_models(spark):
    rows = spark.createDataFrame([("Wind", "Wind blows. No air! the wind again. Wind blows."), ("", "a. b"), (None, "a"), ("x", None)], "text string, section string")
    assert [r.contexts for r in link.sentence_contexts(rows).collect()] == [["Wind blows.", "the wind again."], [], [], []]
    found = spark.createDataFrame([("a", "s", 0, 4, "wind", "Gazetteer-x"), ("b", "s", 0, 4, "wind", "roberta")], "sample_id string, section_id string, start int, end int, text string, model string")
    mentions = spark.createDataFrame([("s", 0, 4, "Wind", "E", "gazetteer", 0.5)], MENTIONS)
    assert sorted((r.sample_id, r.tier) for r in spans.match_mentions(found, mentions).collect()) == [("a", 1), ("b", 2)]
