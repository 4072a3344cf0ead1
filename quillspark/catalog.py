"""The registered queries of the text engine, and the same in SQL for DuckDB.

The tables stand in for the engine's inputs: documents for sections, conversations for titles and abstracts, part and a
small literal table for vocabularies, lineitem for mention spans, embeddings for vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions import text as T
from quillspark.operators import acronyms, analytics, annotate, enrich, filters, gazetteer, link, linking, recognise, sampling, spans, vocabulary
from quillspark.plans import domains
from quillspark.plans.shared import written
from quillspark.sources import files, records

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

VOCAB = [("C1", "thatin", "thing|Thble", "Concept", 9), ("C2", "Ononst", "inoran", "Concept", 4), ("C3", "inoran", "", "Place", 7), ("C4", "thble", "hehely|ertion", "Gene", 2), ("C5", "orantion", "erly|ING", "Gene", 0), ("C1", "duplicate", "ndre", "Place", 99), ("C6", "anat", "", "Species", 5)]
FILTER = filters.MentionFilter.of({"_all": {"ndre"}, "Gene": {"ertion"}}, {"_default": 2, "Concept": 5})
TYPES = {"concept": ["Concept"], "gene": ["Gene", "Protein"], "place": ["Geo"]}
_V = "(VALUES " + ", ".join(f"({', '.join(repr(x) for x in (*r, i))})" for i, r in enumerate(VOCAB)) + ") v(id, concept, synonyms, type, freq, ord)"
#: The vocabulary's lookup table in SQL.
_LOOKUP = f"""vocab AS (SELECT * FROM {_V}), ent AS (SELECT id, arg_min(concept, ord) concept, arg_min(type, ord) AS type, arg_min(freq, ord) freq, min(ord) ord FROM vocab GROUP BY id),
syn AS (SELECT DISTINCT lower(trim(s)) AS key, id FROM (SELECT id, concept, unnest(string_split(synonyms, '|')) s FROM vocab) WHERE trim(s) <> '' AND lower(trim(s)) <> lower(concept)),
lookup AS (SELECT lower(concept) AS key, 0 AS strategy, id, concept, type, freq, ord FROM ent UNION ALL SELECT key, 1, id, concept, type, freq, ord FROM syn JOIN ent USING (id))"""
#: Words of documents with their offsets, and the vocabulary's single-word mentions.
_MENTIONS = f"""seg AS (SELECT doc_id, unnest(l) w, unnest(range(len(l))) k FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_]+') l FROM documents)),
tok AS (SELECT doc_id, w, sum(length(w)) OVER (PARTITION BY doc_id ORDER BY k) - length(w) AS a FROM seg),
term AS (SELECT lower(t) t, arg_max(id, pos) id, arg_max(concept, pos) concept, arg_max(type, pos) AS type FROM (SELECT id, concept, type, ord * 100 AS pos, concept AS t FROM {_V} UNION ALL SELECT id, concept, type, ord * 100 + 1 + k, s FROM (SELECT id, concept, type, ord, unnest(string_split(synonyms, '|')) s, unnest(range(len(string_split(synonyms, '|')))) k FROM {_V}) WHERE s <> '') GROUP BY lower(t)),
mention AS (SELECT doc_id, CAST(a AS INT) AS "start", CAST(a + length(w) AS INT) AS "end", w AS text, type AS entity, id AS linked_id, concept AS linked_name FROM tok JOIN term ON lower(w) = t WHERE NOT (t = 'ing' AND w <> upper(w)))"""
_WHY = "CASE WHEN length(text) < CASE WHEN lower(entity) = 'concept' THEN 5 ELSE 2 END THEN 'too_short' WHEN lower(text) = 'ndre' OR (lower(entity) = 'gene' AND lower(text) = 'ertion') THEN 'blocked' END"
#: Spans made of order lines: a section of many orders, offsets from line numbers and quantities.
_SPANS = "SELECT l_orderkey % 500 AS section_id, CAST(l_orderkey % 97 * 7 + l_linenumber * 5 AS INT) AS \"start\", CAST(l_orderkey % 97 * 7 + l_linenumber * 5 + 1 + l_quantity % 5 AS INT) AS \"end\", l_returnflag AS entity, l_linestatus AS model, (l_orderkey * 10 + l_linenumber) * 10000000 + l_partkey AS k, l_discount AS score FROM lineitem"


def register(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocab(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(*r, i) for i, r in enumerate(VOCAB)], "id string, concept string, synonyms string, type string, freq long, ord int")


def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("section_id"), "text")


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = vocabulary.gazetteer_terms(_vocab(spark).withColumn("synonyms", F.replace("synonyms", F.lit("|"), F.lit(" | "))))
    return gazetteer.match(_sections(spark, sf_dir), terms).withColumn("doc_id", F.col("section_id").cast("long"))


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("l_orderkey") % 97 * 7 + F.col("l_linenumber") * 5
    return _table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 500).alias("section_id"), a.cast("int").alias("start"), (a + 1 + F.col("l_quantity") % 5).cast("int").alias("end"), F.col("l_returnflag").alias("entity"), F.col("l_linestatus").alias("model"), ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 10000000 + F.col("l_partkey")).alias("k"), F.col("l_discount").alias("score"))


def _tokens(kept: Callable[[Column], Column], spark: SparkSession, sf_dir: str, column: str, pattern: str) -> DataFrame:
    """(text): what the pattern finds in every document, of each document's list what ``kept`` leaves.

    An outer explode: for a plain one Spark first filters by the list's size and so searches every text twice.
    """
    found = kept(F.regexp_extract_all(column, F.lit(pattern), F.lit(0)))
    return _table(spark, sf_dir, "documents").select(F.explode_outer(found).alias("text")).where("text is not null")


_TITLES = "SELECT conv_id, max(CASE WHEN turn = 0 THEN trim(regexp_replace(text, '\\s+', ' ', 'g')) END) t, max(CASE WHEN turn = 1 THEN trim(regexp_replace(text, '\\s+', ' ', 'g')) END) a FROM conversations GROUP BY conv_id"
_GLUED = "CASE WHEN coalesce(t, '') <> '' AND coalesce(a, '') <> '' THEN t || CASE WHEN regexp_matches(t, '[.!?]$') THEN ' ' ELSE '. ' END || a WHEN coalesce(t, '') <> '' THEN t ELSE a END"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = lambda k: F.max(F.when(F.col("turn") == k, F.col("text")))
    return _table(spark, sf_dir, "conversations").groupBy("conv_id").agg(one(0).alias("t"), one(1).alias("a")).select(F.col("conv_id").cast("string").alias("oaireid"), F.array("t").alias("titles"), F.array("a").alias("abstracts"))


@register(f"SELECT CAST(conv_id AS VARCHAR) AS section_id, {_GLUED} AS section_content_expanded, CAST(conv_id AS VARCHAR) AS oaireid, CASE WHEN coalesce(t, '') <> '' AND coalesce(a, '') <> '' THEN 'title_abstract' WHEN coalesce(t, '') <> '' THEN 'title' ELSE 'abstract' END AS section_type FROM ({_TITLES}) WHERE coalesce(t, '') <> '' OR coalesce(a, '') <> ''")
def sections_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.title_abstract_sections(_records(spark, sf_dir))


@register(f"SELECT CAST(conv_id AS VARCHAR) || '#title' AS section_id, t AS section_content_expanded, CAST(conv_id AS VARCHAR) AS oaireid, 'title' AS section_type FROM ({_TITLES}) WHERE coalesce(t, '') <> '' UNION ALL SELECT CAST(conv_id AS VARCHAR) || '#abstract', a, CAST(conv_id AS VARCHAR), 'abstract' FROM ({_TITLES}) WHERE coalesce(a, '') <> ''")
def sections_separate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.title_abstract_sections(_records(spark, sf_dir), combine=False)


@register("SELECT CAST(doc_id AS VARCHAR) AS section_id, trim(regexp_replace(CASE WHEN t = '' THEN b WHEN b = '' THEN t WHEN regexp_matches(t, '[.!?:]$') THEN t || ' ' || b ELSE t || '. ' || b END, '\\s+', ' ', 'g')) AS section_content_expanded, CAST(doc_id AS VARCHAR) AS \"rsNr\", 'legal_text' AS section_type, t AS title FROM (SELECT doc_id, coalesce(source, '') || ' ' || lang || CASE doc_id % 3 WHEN 0 THEN ':' WHEN 1 THEN '' ELSE '?' END AS t, trim(text, e' \\n\\t\\r') AS b FROM documents)")
def legal_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat(F.coalesce("source", F.lit("")), F.lit(" "), "lang", F.when(F.col("doc_id") % 3 == 0, ":").when(F.col("doc_id") % 3 == 1, "").otherwise("?"))
    return records.legal_sections(_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("rsNr"), title.alias("en_lawTitle"), F.col("text").alias("en_lawText")))


@register(f'WITH {_MENTIONS} SELECT doc_id, "start", "end", text, entity, linked_id, linked_name FROM mention')
def gazetteer_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions(spark, sf_dir).select("doc_id", "start", "end", "text", "entity", "linked_id", "linked_name")


_TERMS = "of the and|the thing|of the|in the|the"


@register(f"WITH s AS (SELECT doc_id, unnest(l) w, unnest(range(len(l))) k FROM (SELECT doc_id, regexp_extract_all(text, '(?is)\\b(?:{_TERMS})\\b|[A-Za-z0-9_]+|[^A-Za-z0-9_]') l FROM documents)), t AS (SELECT doc_id, w, lower(w) t, sum(length(w)) OVER (PARTITION BY doc_id ORDER BY k) AS b FROM s) SELECT CAST(doc_id AS VARCHAR) AS section_id, CAST(b - length(w) AS INT) AS \"start\", CAST(b AS INT) AS \"end\", w AS text, CASE t WHEN 'the thing' THEN 'Concept' WHEN 'the' THEN 'Gene' ELSE 'Place' END AS entity, CAST(1.0 AS DOUBLE) AS score, 'Gazetteer' AS model, CASE t WHEN 'the thing' THEN 'M1' WHEN 'the' THEN 'M3' ELSE 'M2' END AS linked_id, CASE t WHEN 'the thing' THEN 'the thing' WHEN 'the' THEN 'the' ELSE 'of the' END AS linked_name FROM t WHERE list_contains(string_split('{_TERMS}', '|'), t)")
def gazetteer_multitoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [("M1", "the thing", "", "Concept", 1, 0), ("M2", "of the", "of the and|in the", "Place", 1, 1), ("M3", "the", "", "Gene", 1, 2)]
    vocab = spark.createDataFrame(rows, "id string, concept string, synonyms string, type string, freq long, ord int").withColumn("synonyms", F.replace("synonyms", F.lit("|"), F.lit(" | ")))
    return gazetteer.match(_sections(spark, sf_dir), vocabulary.gazetteer_terms(vocab))


@register(f"WITH {_MENTIONS} SELECT entity, count(*) AS total, count(*) FILTER (why IS NULL) AS kept, count(*) FILTER (why = 'too_short') AS too_short, count(*) FILTER (why = 'blocked') AS blocked FROM (SELECT *, {_WHY} AS why FROM mention) GROUP BY entity")
def mention_filter_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FILTER.stats(_mentions(spark, sf_dir), ["entity"])


@register(f"WITH {_MENTIONS}, {_LOOKUP}, kept AS (SELECT *, {_WHY} AS why FROM mention), best AS (SELECT t, arg_min(id, r) AS id FROM (SELECT t, id, row_number() OVER (PARTITION BY t ORDER BY p, strategy, freq DESC, ord, id) r FROM (SELECT DISTINCT lower(text) t, text FROM kept) m, (SELECT unnest([0, 1]) p) q, lookup WHERE key = CASE p WHEN 0 THEN lower(text) WHEN 1 THEN CASE WHEN length(text) < 4 THEN NULL WHEN text LIKE '%ies' THEN lower(left(text, length(text) - 3) || 'y') WHEN text LIKE '%es' AND text NOT LIKE '%ases' THEN lower(left(text, length(text) - 2)) WHEN text LIKE '%s' AND text NOT LIKE '%ss' THEN lower(left(text, length(text) - 1)) END END) GROUP BY t) SELECT entity, count(*) AS total, count(id) AS linked, round(100.0 * count(id) / count(*), 4) AS linked_pct FROM kept LEFT JOIN best ON t = lower(text) WHERE why IS NULL GROUP BY entity")
def exact_link_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions by gazetteer, filtered, linked anew by exact lookup with variants; the linking rate by type."""
    kept = written(FILTER.apply(_mentions(spark, sf_dir)).select("doc_id", "start", "end", "text", "entity"))
    linked = link.exact(kept, _vocab(spark))
    return linked.groupBy("entity").agg(F.count("*").alias("total"), F.count("linked_id").alias("linked")).withColumn("linked_pct", F.round(100.0 * F.col("linked") / F.col("total"), 4))


#: The best entry of every text in ``asked`` (t), by its own spelling and its singular.
_BEST = """SELECT t, arg_min(id, r) AS id FROM (SELECT t, id, row_number() OVER (PARTITION BY t ORDER BY p, strategy, freq DESC, ord, id) r FROM asked, (SELECT unnest([0, 1]) p) q, lookup WHERE key = CASE p WHEN 0 THEN lower(t) WHEN 1 THEN CASE WHEN length(t) < 4 THEN NULL WHEN t LIKE '%ies' THEN lower(left(t, length(t) - 3) || 'y') WHEN t LIKE '%es' AND t NOT LIKE '%ases' THEN lower(left(t, length(t) - 2)) WHEN t LIKE '%s' AND t NOT LIKE '%ss' THEN lower(left(t, length(t) - 1)) END END) GROUP BY t"""


@register(f"WITH {_LOOKUP}, asked AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z0-9_]+')) AS t FROM documents), best AS ({_BEST}) SELECT t AS text, id AS linked_id FROM best")
def exact_link_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entry of every distinct word of the documents that has one."""
    words = written(_tokens(F.array_distinct, spark, sf_dir, "text", "[A-Za-z0-9_]+").distinct())  # read twice by the linker
    return link.exact(words.withColumn("entity", F.lit("Concept")), _vocab(spark)).where("linked_id is not null").select("text", "linked_id")


_VAR = ["ifn-γ", "erk1 / 2", "receptors", "therapies", "class", "il - 6 receptors", "θ-wave", "plain"]


@register("SELECT * FROM (VALUES ('ifn-γ', 'ifn-γ|ifn-g|ifng'), ('erk1 / 2', 'erk1 / 2|erk1/2'), ('receptors', 'receptors|receptor'), ('therapies', 'therapies|therapy'), ('class', 'class'), ('il - 6 receptors', 'il - 6 receptors|il-6 receptors|il - 6 receptor|il-6 receptor'), ('θ-wave', 'θ-wave|th-wave'), ('plain', 'plain')) t(text, variants)")
def greek_spacing_plural_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(x,) for x in _VAR], "text string").select("text", F.array_join(T.variants(F.col("text")), "|").alias("variants"))


@register("SELECT DISTINCT key, strategy, id, freq FROM (SELECT lower(p_name) AS key, 0 AS strategy, CAST(p_partkey AS VARCHAR) AS id, CAST(p_size AS BIGINT) AS freq FROM part UNION ALL SELECT lower(trim(s)), 1, id, freq FROM (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name, unnest([p_type, p_brand]) s, CAST(p_size AS BIGINT) AS freq FROM part) WHERE trim(s) <> '' AND lower(trim(s)) <> lower(p_name))")
def vocab_lookup_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("concept"), F.concat_ws("|", "p_type", "p_brand").alias("synonyms"), F.lit("Part").alias("type"), F.col("p_size").alias("freq"), F.col("p_partkey").alias("ord"))
    return vocabulary.lookup(p).select("key", "strategy", "id", "freq")


@register("SELECT CAST(p_partkey AS VARCHAR) AS id, p_type || CASE WHEN p_partkey % 3 = 0 THEN CASE WHEN lower(p_type) = 'promo' THEN '|new' ELSE '|Promo|new' END ELSE '' END AS synonyms FROM part")
def vocab_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_type").alias("synonyms"), F.col("p_partkey").alias("ord"))
    add = p.where("ord % 3 = 0").select("id", F.array(F.lit("Promo"), F.lit("new")).alias("add"))
    return vocabulary.patch(p, add).select("id", "synonyms")


@register(f"WITH s AS ({_SPANS}) SELECT section_id, \"start\", \"end\", k FROM s n WHERE entity <> 'R' AND NOT EXISTS (SELECT 1 FROM s g WHERE g.entity = 'R' AND g.section_id = n.section_id AND n.\"start\" < g.\"end\" AND n.\"end\" > g.\"start\")")
def overlap_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spans(spark, sf_dir)
    return spans.without_overlaps(s.where("entity <> 'R'").select("section_id", "start", "end", "k"), s.where("entity = 'R'"))


@register(f"WITH s AS ({_SPANS}), m AS (SELECT *, CASE WHEN entity = lag(entity) OVER w AND model = lag(model) OVER w AND \"start\" - lag(\"end\") OVER w BETWEEN 0 AND 1 THEN 0 ELSE 1 END AS b FROM s WINDOW w AS (PARTITION BY section_id ORDER BY \"start\", \"end\", k)), i AS (SELECT *, sum(b) OVER (PARTITION BY section_id ORDER BY \"start\", \"end\", k ROWS UNBOUNDED PRECEDING) AS g FROM m) SELECT section_id, min(\"start\") AS \"start\", arg_max(\"end\", struct_pack(a := \"start\", b := \"end\", c := k)) AS \"end\", arg_min(entity, struct_pack(a := \"start\", b := \"end\", c := k)) AS entity, arg_min(score, struct_pack(a := \"start\", b := \"end\", c := k)) AS score, string_agg(CAST(k AS VARCHAR), ' ' ORDER BY \"start\", \"end\", k) AS text FROM i GROUP BY section_id, g")
def merge_adjacent_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.merge_adjacent(_spans(spark, sf_dir).withColumn("text", F.col("k").cast("string")), ties=("k",)).select("section_id", "start", "end", "entity", "score", "text")


@register(f"SELECT section_id, entity, \"start\", \"end\", min(k) AS k FROM ({_SPANS}) GROUP BY ALL")
def chunk_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.first_of_span(_spans(spark, sf_dir), ["k"]).select("section_id", "entity", "start", "end", "k")


@register(f"WITH s AS (SELECT section_id, \"start\", max(\"end\") AS \"end\", max(k) % 8 / 8 AS score FROM ({_SPANS}) GROUP BY ALL), m AS (SELECT *, CASE WHEN \"start\" - lag(\"end\") OVER (PARTITION BY section_id ORDER BY \"start\", \"end\") <= 1 THEN 0 ELSE 1 END b FROM s), i AS (SELECT *, sum(b) OVER (PARTITION BY section_id ORDER BY \"start\", \"end\" ROWS UNBOUNDED PRECEDING) g FROM m) SELECT section_id, min(\"start\") AS \"start\", arg_max(\"end\", \"start\") AS \"end\", count(*) AS n, list_reduce(list(CAST(score AS DOUBLE) ORDER BY \"start\"), lambda x, y: (x + y) / 2) AS score FROM i GROUP BY section_id, g")
def geo_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spans(spark, sf_dir).groupBy("section_id", "start").agg(F.max("end").alias("end"), (F.max("k") % 8 / 8).alias("score")).withColumn("text", F.lit("x"))
    return spans.merge_places(s).select("section_id", "start", "end", F.size(F.split("text", " ")).cast("long").alias("n"), "score")


@register("WITH w AS (SELECT doc_id, regexp_extract_all(text, '\\s*\\S+') p FROM documents), c AS (SELECT doc_id, p, unnest(range(CAST(greatest(0, ceil((len(p) - 100) / 75.0)) AS BIGINT) + 1)) AS chunk FROM w WHERE len(p) > 0), t AS (SELECT doc_id, chunk, array_to_string(p[1:chunk * 75], '') a, array_to_string(p[chunk * 75 + 1:chunk * 75 + 100], '') b FROM c) SELECT doc_id, CAST(chunk AS INT) AS chunk, CAST(length(a) + length(b) - length(ltrim(b, e' \\n\\t\\r')) AS INT) AS \"offset\", md5(ltrim(b, e' \\n\\t\\r')) AS text_md5 FROM t")
def chunk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = recognise.chunks(_sections(spark, sf_dir), 100, 25)
    return made.select(F.col("section_id").cast("long").alias("doc_id"), "chunk", F.col("offset").cast("int").alias("offset"), F.md5("text").alias("text_md5"))


@register(f'WITH {_MENTIONS} SELECT DISTINCT lower(text) AS key, first_value(doc_id) OVER w AS doc_id, first_value("start") OVER w AS "start" FROM mention WINDOW w AS (PARTITION BY lower(text) ORDER BY doc_id, "start")')
def link_memo_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.first_uses(_mentions(spark, sf_dir).select("doc_id", "start", "text"), ["doc_id", "start"]).select("key", "doc_id", "start")


_TOP = "SELECT q.vec_id AS query, e.vec_id AS entry, round(list_sum(list_transform(range(1, 65), lambda i: CAST(q.embedding[i] AS DOUBLE) * CAST(e.embedding[i] AS DOUBLE))), 4) AS score FROM (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q, embeddings e"


def _top(spark: SparkSession, sf_dir: str, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = _table(spark, sf_dir, "embeddings")
    queries = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("vector"))
    entries = e.select(F.col("vec_id").alias("entry"), F.col("embedding").alias("vector"))
    return queries, entries, link.top_k(queries, entries, k, 4)


@register(f"SELECT query, entry, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, entry) AS rank FROM ({_TOP})) WHERE rank <= 7")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, 7)[2].withColumn("rank", F.col("rank").cast("long"))


@register(f"SELECT query, entry, score FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, entry) AS rank FROM ({_TOP})) WHERE rank = 1 AND score >= 0.5")
def vector_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.best_above(_top(spark, sf_dir, 1)[2], 0.5)


@register(f"WITH t AS ({_TOP}), c AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, entry) AS rank FROM t QUALIFY rank <= 7), f AS (SELECT t.query, t.entry, t.score, 7 + row_number() OVER (PARTITION BY t.query ORDER BY t.entry) AS rank FROM t LEFT JOIN c ON c.query = t.query AND c.entry = t.entry WHERE t.entry < 5 AND c.entry IS NULL) SELECT query, entry, score, rank FROM c UNION ALL SELECT * FROM f")
def topk_with_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, entries, top = _top(spark, sf_dir, 7)
    return link.with_fallbacks(top, queries, entries.where("entry < 5"), 4).withColumn("rank", F.col("rank").cast("long"))


@register("SELECT label, CAST(d - 1 AS INT) AS d, round(avg(CAST(embedding[d] AS DOUBLE)), 4) AS m FROM embeddings, (SELECT unnest(range(1, 65)) AS d) GROUP BY label, d")
def centroid_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.centroids(_table(spark, sf_dir, "embeddings"), "label", "embedding", 4).select("label", F.posexplode("centroid").alias("d", "m"))


@register("SELECT * FROM (VALUES ('3', 7, 3), ('[2] x', 7, 2), ('reject', 7, NULL), ('10', 7, 1), ('9', 7, NULL), ('', 7, NULL)) t(answer, n, choice)")
def llm_answer_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([("3", 7), ("[2] x", 7), ("reject", 7), ("10", 7), ("9", 7), ("", 7)], "answer string, n int").select("answer", "n", T.answer_choice(F.col("answer"), F.col("n")).alias("choice"))


@register("SELECT p_partkey, CASE lower(p_type) WHEN 'economy' THEN p_brand = 'Brand#11' OR p_brand = 'Brand#12' ELSE lower(p_brand) = lower(p_type) END AS agrees FROM part")
def type_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select("p_partkey", link.types_agree(F.col("p_type"), F.col("p_brand"), {"Economy": ["Brand#11", "Brand#12"]}).alias("agrees"))


@register(f"WITH s AS ({_SPANS}), a AS (SELECT k AS sample_id, section_id, \"start\" + k % 2 AS \"start\", \"end\", entity AS text FROM s), h AS (SELECT sample_id, CASE WHEN a.\"start\" = s.\"start\" AND a.\"end\" = s.\"end\" THEN 1 ELSE 2 END tier, s.\"start\" ms, s.\"end\" me FROM a JOIN s ON a.section_id = s.section_id AND abs(a.\"start\" - s.\"start\") <= 1 AND abs(a.\"end\" - s.\"end\") <= 1 AND lower(a.text) = lower(s.entity)) SELECT a.sample_id, b.tier, b.ms AS m_start, b.me AS m_end FROM a LEFT JOIN (SELECT sample_id, unnest(min(struct_pack(tier, ms, me))) FROM h GROUP BY sample_id) b USING (sample_id)")
def annotation_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spans(spark, sf_dir)
    samples = s.select(F.col("k").alias("sample_id"), "section_id", (F.col("start") + F.col("k") % 2).cast("int").alias("start"), "end", F.col("entity").alias("text"))
    return spans.match_mentions(samples, s.withColumn("text", F.col("entity"))).select("sample_id", "tier", "m_start", "m_end")


@register(f"SELECT k, left(md5(CAST(section_id AS VARCHAR)), 8) || '#' || \"start\" || '-' || \"end\" AS id, \"start\" AS \"start\", \"end\" AS \"end\" FROM ({_SPANS})")
def sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = _spans(spark, sf_dir).select("k", T.sample_id(F.col("section_id").cast("string"), F.col("start"), F.col("end")).alias("id"))
    parsed = T.parse_sample_id(F.col("id"))
    return made.select("k", "id", parsed["start"].alias("start"), parsed["end"].alias("end"))


@register(f"WITH {_MENTIONS}, m AS (SELECT doc_id || '-' || \"start\" AS k, text FROM mention) SELECT k, text FROM m QUALIFY row_number() OVER (PARTITION BY lower(text) ORDER BY md5('42#' || k), k) <= 2")
def mention_cap_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.capped(_mentions(spark, sf_dir).select(F.concat_ws("-", "doc_id", "start").alias("k"), "text"), "k")


@register("WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42#' || doc_id), doc_id) AS n FROM documents) SELECT doc_id, lang FROM r ORDER BY n > greatest(1, 50 // (SELECT count(DISTINCT lang) FROM documents)), md5('42#' || doc_id), doc_id LIMIT 50")
def stratified_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified(_table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 50)


@register(f"WITH {_MENTIONS} SELECT *, total - linked AS unlinked, round(100.0 * linked / total, 4) AS linked_pct FROM (SELECT lower(entity) AS entity, count(*) AS total, count(DISTINCT lower(text)) AS distinct_mentions, count(*) FILTER (linked_id <> 'C4') AS linked FROM mention GROUP BY 1)")
def type_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.type_stats(_mentions(spark, sf_dir).withColumn("linked_id", F.when(F.col("linked_id") != "C4", F.col("linked_id"))))


@register(f"WITH {_MENTIONS} SELECT lower(text) AS term, count(*) AS n FROM mention WHERE linked_id IN ('C4', 'C5') GROUP BY 1 ORDER BY n DESC, term LIMIT 250")
def top_unlinked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.top_unlinked(_mentions(spark, sf_dir).withColumn("linked_id", F.when(~F.col("linked_id").isin("C4", "C5"), F.col("linked_id"))))


#: Marker words, each with a blank after it, written out for the SQL by themselves.
_MARKERS = {"en": "the is are was were have has been will would could should this that with from", "es": "de del la las el los un una es en que por para", "fr": "un une du des de le les la est sont dans pour", "de": "ist sind und mit auf die der das wird werden für"}
_COUNTS = ", ".join(" + ".join(f"contains(t, '{w} ')::INT" for w in words.split()) + (" + contains(t, 'l' || chr(39))::INT + contains(t, 'd' || chr(39))::INT" if k == "fr" else "") + f" AS {k}" for k, words in _MARKERS.items())


@register(f"WITH l AS (SELECT text, lower(text) t FROM documents), s AS (SELECT text, {_COUNTS} FROM l) SELECT language, count(*) AS n FROM (SELECT CASE WHEN length(text) < 20 THEN 'unknown' WHEN regexp_matches(text, '[\u0600-\u06ff]') THEN 'ar' WHEN regexp_matches(text, '[\u4e00-\u9fff]') THEN 'zh' WHEN greatest(en, es, fr, de) < 3 THEN 'unknown' WHEN en = greatest(en, es, fr, de) THEN 'en' WHEN es = greatest(en, es, fr, de) THEN 'es' WHEN fr = greatest(en, es, fr, de) THEN 'fr' ELSE 'de' END AS language FROM s) GROUP BY language")
def lang_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gazetteer.spread(_table(spark, sf_dir, "documents").select("text")).select(T.language(F.col("text")).alias("language")).groupBy("language").agg(F.count("*").alias("n"))


#: The class of every term in ``terms`` (term, n) against the parts' names.
_CLASS = """kw AS (SELECT DISTINCT term, unnest(list_filter(regexp_extract_all(lower(term), '\\w+'), lambda w: length(w) > 3 AND NOT list_contains(string_split('acute advanced cell chronic early from grade high late like low metastatic primary recurrent secondary stage type with', ' '), w))[1:2]) AS w FROM terms),
hit AS (SELECT DISTINCT term FROM kw JOIN (SELECT DISTINCT lower(p_name) c FROM part) ON contains(c, w)),
classed AS (SELECT term, n, CASE WHEN list_contains(string_split('death disease disorder fatigue fever illness infection inflammation lesion lesions mass metastasis nausea nodule pain syndrome toxicity tumor tumors', ' '), term) THEN 'SKIP' WHEN length(term) <= 5 AND regexp_full_match(replace(term, '-', ''), '[\\p{L}\\p{N}]+') THEN 'ABBREV' WHEN term IN (SELECT term FROM hit) THEN 'SYNONYM' WHEN contains(term, 'cancer') OR contains(term, 'carcinoma') OR contains(term, 'syndrome') THEN 'MISSING' ELSE 'UNKNOWN' END AS class FROM terms)"""
#: Words of documents and of parts' names, as mention texts.
_WORDS = "SELECT lower(w) AS term, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9_-]+')) w FROM documents UNION ALL SELECT p_name || ' ' || p_type FROM part) GROUP BY 1"


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("concept"), F.col("p_brand").alias("synonyms"), F.col("p_type").alias("type"), F.col("p_size").cast("long").alias("freq"), F.col("p_partkey").alias("ord"))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _tokens(lambda found: found, spark, sf_dir, "text", "[A-Za-z0-9_-]+")
    return words.unionByName(_table(spark, sf_dir, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("text"))).withColumn("linked_id", F.lit(None).cast("string"))


@register(f"WITH terms AS ({_WORDS}), {_CLASS} SELECT term, n, class FROM classed")
def unlinked_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = _words(spark, sf_dir).groupBy(F.lower("text").alias("term")).agg(F.count("*").alias("n"))
    return analytics.classify_unlinked(terms, _parts(spark, sf_dir))


@register(f"WITH every AS ({_WORDS}), terms AS (SELECT * FROM (SELECT term, n FROM every ORDER BY n DESC, term LIMIT 500) WHERE term NOT IN (SELECT lower(p_name) FROM part UNION SELECT lower(p_brand) FROM part)), {_CLASS} SELECT class, count(*) AS terms, CAST(sum(n) AS BIGINT) AS mentions, round(sum(n) / (SELECT sum(n) FROM every), 6) AS share FROM classed GROUP BY class")
def unlinked_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.unlinked_report(_words(spark, sf_dir), _parts(spark, sf_dir))


@register("WITH q AS (SELECT DISTINCT lower(p_name) AS term FROM part), kw AS (SELECT term, unnest(l) w, unnest(range(len(l))) k FROM (SELECT term, list_filter(regexp_extract_all(term, '\\w+'), lambda w: length(w) > 3)[1:2] l FROM q)), few AS (SELECT w, p_partkey, p_name FROM (SELECT DISTINCT w FROM kw) JOIN part ON contains(lower(p_name), w) QUALIFY row_number() OVER (PARTITION BY w ORDER BY p_partkey, CAST(p_partkey AS VARCHAR)) <= 5) SELECT term, CAST(p_partkey AS VARCHAR) AS id, p_name AS concept, CAST(row_number() OVER (PARTITION BY term ORDER BY k, p_partkey) AS INT) AS rank FROM (SELECT term, p_partkey, p_name, min(k) k FROM kw JOIN few USING (w) GROUP BY ALL) QUALIFY rank <= 5")
def candidate_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parts(spark, sf_dir)
    return analytics.candidates(p.select(F.lower("concept").alias("term")), p)


@register("SELECT term FROM (SELECT DISTINCT lower(w) AS term FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z0-9_#]+')) w FROM documents) UNION SELECT p_name FROM part UNION SELECT upper(p_brand) FROM part) WHERE lower(term) IN (SELECT lower(p_name) FROM part UNION SELECT lower(p_brand) FROM part)")
def known_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9_#]+"), F.lit(0))).alias("term"))
    p = _table(spark, sf_dir, "part")
    return analytics.known_terms(words.union(p.select("p_name")).union(p.select(F.upper("p_brand"))).distinct(), _parts(spark, sf_dir))


@register(f"WITH a AS (SELECT lower(trim(p_type)) AS type, count(*) AS mentions FROM part GROUP BY 1), b AS (SELECT lower(trim(type)) AS type, count(*) AS entries FROM (SELECT type FROM {_V} UNION ALL SELECT 'promo') GROUP BY 1) SELECT coalesce(a.type, b.type) AS type, mentions, entries, CASE WHEN entries IS NULL THEN 'mentions only' WHEN mentions IS NULL THEN 'vocabulary only' ELSE 'matched' END AS status FROM a FULL JOIN b ON a.type = b.type")
def type_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.compare_types(_table(spark, sf_dir, "part").select(F.col("p_type").alias("type")), _vocab(spark).select("type").unionByName(spark.createDataFrame([("Promo",)], "type string")))


@register("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.plans.run import pending

    return pending(_table(spark, sf_dir, "documents").select("doc_id", "lang"), _table(spark, sf_dir, "labels"), "doc_id")


@register("SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(html, '[\\n\\t]+', ', ', 'g'), '[ \\n\\t\\r]*,[ \\n\\t\\r]*', ', ', 'g'), '[ \\n\\t\\r]{2,}', ' ', 'g'), ' ,;')) AS cleaned FROM pages")
def affiliation_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "pages").select("page_id", F.md5(T.affiliation(F.col("html"))).alias("cleaned"))


@register("SELECT * FROM (VALUES ('http://x/Q42|Q1', 'Q42'), ('Q7', 'Q7'), ('none', ''), ('|Q9', '')) t(raw, qid)")
def qid_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([("http://x/Q42|Q1",), ("Q7",), ("none",), ("|Q9",)], "raw string").select("raw", T.qid(F.col("raw")).alias("qid"))


@register(f"WITH s AS ({_SPANS}), o AS (SELECT * FROM s WHERE entity <> 'N') SELECT section_id, \"start\", \"end\", k, model FROM o WHERE model <> 'F' UNION ALL SELECT section_id, \"start\", \"end\", k, 'NewGazetteer' FROM s WHERE entity = 'A' AND section_id IN (SELECT section_id FROM o)")
def gazetteer_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spans(spark, sf_dir).select("section_id", "start", "end", "k", "model", "entity")
    old = s.where("entity <> 'N'").drop("entity").withColumn("model", F.when(F.col("model") == "F", "OldGazetteer").otherwise(F.col("model")))
    return spans.replace_gazetteer(old, s.where("entity = 'A'").drop("entity").withColumn("model", F.lit("NewGazetteer")))


@register("WITH d AS (SELECT p_partkey, p_name, upper(list_aggregate(list_transform(string_split(p_name, ' '), lambda w: w[1]), 'string_agg', '')) AS a FROM part) SELECT CAST(p_partkey AS VARCHAR) AS file_path, a AS short, p_name AS long_form, p_name || ' (' || p_name || ') sells. The ' || p_name || ' and X' || a || ' stay' AS section_content_expanded FROM d")
def acronym_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that define an acronym of a part's name and use it; the map that is found, and the expanded text."""
    p = _table(spark, sf_dir, "part")
    short = F.upper(F.array_join(F.transform(F.split("p_name", " "), lambda w: F.substring(w, 1, 1)), ""))
    text = F.concat("p_name", F.lit(" ("), short, F.lit(") sells. The "), short, F.lit(" and X"), short, F.lit(" stay"))
    docs = p.select(F.col("p_partkey").cast("string").alias("file_path"), text.alias("fulltext"))
    made = acronyms.expand_sections(docs.select("file_path", F.col("fulltext").alias("section_content")), docs)
    return made.select("file_path", F.inline("acronym_map"), "section_content_expanded").withColumnRenamed("full", "long_form").select("file_path", "short", "long_form", "section_content_expanded")


_LINKERS = {"concept": domains.Linker("all", "SRC-C"), "gene": domains.Linker("all", "SRC-G")}
#: The linking run over the mentions: filtered, by type; sections without a letter T have no text and pass through.
_RUN = f"""{_LOOKUP}, here AS (SELECT m.*, contains(d.text, 'T') AS has FROM mention m JOIN documents d USING (doc_id)), kept AS (SELECT * FROM (SELECT *, {_WHY} AS why FROM here) WHERE why IS NULL OR NOT has),
asked AS (SELECT DISTINCT first_value(text) OVER (PARTITION BY lower(entity), lower(text) ORDER BY CAST(doc_id AS VARCHAR), "start") AS t FROM kept WHERE has AND entity IN ('Concept', 'Gene')), best AS ({_BEST}), low AS (SELECT lower(t) AS t, min(id) AS id FROM best GROUP BY 1),
run AS (SELECT doc_id, entity, text, "start", CASE WHEN has AND entity IN ('Concept', 'Gene') THEN low.id END AS linked_id FROM kept LEFT JOIN low ON low.t = lower(text))"""


def _run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mentions, sections (a text without a T is empty) and the linked mentions."""
    mentions = written(_mentions(spark, sf_dir).select("doc_id", "section_id", "start", "end", "text", "entity"))
    sections = _sections(spark, sf_dir).withColumn("text", F.when(F.col("text").contains("T"), F.col("text")).otherwise(""))
    return mentions, sections, linking.link_by_type(mentions, sections, {"all": _vocab(spark)}, _LINKERS, FILTER)


@register(f"WITH {_MENTIONS}, {_RUN} SELECT doc_id, \"start\", text, entity, linked_id, CASE WHEN linked_id IS NOT NULL THEN CASE entity WHEN 'Concept' THEN 'SRC-C' ELSE 'SRC-G' END END AS source FROM run")
def el_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)[2].select("doc_id", "start", "text", "entity", "linked_id", "source")


@register(f"WITH {_MENTIONS}, {_RUN}, f AS (SELECT doc_id, count(*) AS total, count(*) FILTER (why IS NULL) AS kept, count(*) FILTER (why = 'too_short') AS too_short, count(*) FILTER (why = 'blocked') AS blocked FROM (SELECT *, {_WHY} AS why FROM here) GROUP BY doc_id), r AS (SELECT doc_id, count(linked_id) AS linked, count(DISTINCT lower(text)) AS cached FROM run GROUP BY doc_id) SELECT doc_id, total, kept, too_short, blocked, coalesce(linked, 0) AS linked, CAST(0 AS BIGINT) AS mismatched, coalesce(cached, 0) AS cached, CASE WHEN kept > 0 THEN round(coalesce(linked, 0) / kept, 6) ELSE 0 END AS rate FROM f LEFT JOIN r USING (doc_id)")
def el_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions, _, linked = _run(spark, sf_dir)
    return linking.statistics(mentions, linked, FILTER, "doc_id")


@register(f"WITH {_MENTIONS}, cand AS (SELECT t AS query, arg_min(id, r) AS entry, max(s) FILTER (r = 1) AS score FROM (SELECT lower(m.text) t, v.id, v.freq / 10.0 AS s, row_number() OVER (PARTITION BY lower(m.text) ORDER BY v.freq DESC, v.id) r FROM (SELECT DISTINCT lower(text) AS text, entity FROM mention) m JOIN (SELECT id, max(freq) freq, arg_min(type, ord) AS type FROM {_V} GROUP BY id) v ON v.type = m.entity) GROUP BY t) SELECT doc_id, \"start\", text, CASE WHEN score >= 0.45 THEN entry END AS linked_id, CASE WHEN score >= 0.45 THEN CAST(round(score, 4) AS DOUBLE) END AS score FROM mention LEFT JOIN cand ON lower(text) = query")
def rerank_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reranker's choice among the entries of a mention's type, the commonest first."""
    mentions = written(_mentions(spark, sf_dir).select("doc_id", "section_id", "start", "end", "text", "entity"))
    entries = _vocab(spark).groupBy("id").agg(F.max("freq").alias("freq"), F.min_by("type", "ord").alias("type"), F.min_by("concept", "ord").alias("name"))
    pairs = mentions.select(F.lower("text").alias("query"), "entity").distinct().join(entries, F.col("type") == F.col("entity"))
    w = Window.partitionBy("query").orderBy(F.desc("freq"), "id")
    candidates = pairs.select("query", F.col("id").alias("entry"), F.round(F.col("freq") / 10, 4).alias("score"), F.row_number().over(w).alias("rank"))
    made = linking.rerank_sections(mentions, _sections(spark, sf_dir), candidates, entries.select(F.col("id").alias("entry"), "name"), linking.FirstCandidate(0.45), threshold=0.4)
    return made.select("doc_id", "start", "text", "linked_id", "score")


#: Mentions as a linked run gives them: C4 unlinked, C1 with a second link.
_LINKED = "SELECT doc_id, \"start\", \"end\", text, entity, CASE WHEN linked_id <> 'C4' THEN linked_id END AS lid, linked_name, left(md5(CAST(doc_id AS VARCHAR)), 8) || '#' || \"start\" || '-' || \"end\" AS id FROM mention"


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _mentions(spark, sf_dir)
    one = lambda source, ident, name, score: F.struct(F.lit(source).alias("source"), ident.alias("id"), name.alias("name"), score.alias("score"))
    first = one("V", F.col("linked_id"), F.col("linked_name"), F.length("text") / 100)
    second = F.when(F.col("linked_id") == "C1", one("Wikidata", F.lit("Q1"), F.lit("wiki"), F.lit(None).cast("double")))
    linked = m.withColumn("linking", F.when(F.col("linked_id") != "C4", F.array_compact(F.array(first, second)))).withColumn("source_file", F.col("section_id"))
    return written(linked.select("section_id", "start", "end", "text", "entity", "model", "linking", "source_file", "score"))


@register(f"WITH {_MENTIONS}, l AS ({_LINKED}) SELECT id, text AS mention, 'Gazetteer' AS linking_model, coalesce(lid, '[UNLINKED]') AS linked_to_concept_id, CASE WHEN lid IS NULL THEN '' ELSE linked_name END AS linked_to_name, entity AS entity_type, CASE WHEN lid = 'C1' THEN 'Q1' ELSE '' END AS linked_to_wikidata_id, CAST(doc_id AS VARCHAR) AS source_file, lid IS NOT NULL AS is_linked FROM l")
def annotation_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = annotate.samples(_samples(spark, sf_dir), _sections(spark, sf_dir), sentences=False)
    return found.select("id", "mention", "linking_model", "linked_to_concept_id", "linked_to_name", "entity_type", "linked_to_wikidata_id", "source_file", "is_linked")


@register(f"WITH {_MENTIONS}, l AS ({_LINKED}), e AS (SELECT id, arg_min(type, ord) AS type FROM {_V} GROUP BY id) SELECT l.id, CAST(1.0 AS DOUBLE) AS score_ner, CASE WHEN lid IS NOT NULL THEN length(text) / 100 END AS score_el, coalesce(e.type, '') AS taxonomy_type, CASE WHEN e.type IS NULL THEN 'na' WHEN e.type <> 'Place' AND lower(entity) = lower(e.type) THEN 'yes' ELSE 'no' END AS type_match FROM l LEFT JOIN e ON e.id = lid")
def annotation_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = _samples(spark, sf_dir)
    types = _vocab(spark).groupBy("id").agg(F.min_by("type", "ord").alias("type"))
    check = annotate.type_check(F.col("entity_type"), F.col("taxonomy_type"), {"d": {"Concept": ["concept", "idea"]}, "e": {"Place": ["region"]}}, "d")
    found = annotate.samples(mentions, _sections(spark, sf_dir), sentences=False)
    return annotate.enriched(found, mentions, types, check).select("id", "score_ner", F.round("score_el", 6).alias("score_el"), "taxonomy_type", "type_match")


@register(f"WITH {_MENTIONS}, l AS ({_LINKED}), c AS (SELECT id, text, entity FROM l QUALIFY row_number() OVER (PARTITION BY entity, lower(text) ORDER BY md5('42#' || id), id) <= 3), r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY md5('42#' || id), id) AS n FROM c) SELECT id, text, entity FROM r ORDER BY n > greatest(1, 40 // (SELECT count(DISTINCT entity) FROM l)), md5('42#' || id), id LIMIT 40")
def two_level_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _mentions(spark, sf_dir).select(T.sample_id(F.col("section_id"), F.col("start"), F.col("end")).alias("id"), "text", "entity")
    return annotate.two_level(rows, "entity", "id", 40, text="text")


@register(f"WITH {_MENTIONS} SELECT m.doc_id, m.\"start\", substring(d.text, m.\"start\" + 1 + m.\"start\" % 2, length(m.text)) AS found, substring(d.text, m.\"start\" + 1 + m.\"start\" % 2, length(m.text)) = m.text OR lower(substring(d.text, m.\"start\" + 1 + m.\"start\" % 2, length(m.text))) = lower(m.text) AS holds FROM mention m JOIN documents d USING (doc_id) WHERE m.\"end\" + m.\"start\" % 2 <= length(d.text)")
def offset_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions whose odd starts are shifted by one, held against their text."""
    shift = F.col("start") % 2
    m = _mentions(spark, sf_dir).select("doc_id", "section_id", F.col("start").alias("at"), (F.col("start") + shift).alias("start"), (F.col("end") + shift).alias("end"), "text")
    return analytics.inspect_offsets(m, _sections(spark, sf_dir)).where("found is not null").select("doc_id", F.col("at").alias("start"), "found", "holds")


@register(f"WITH s AS ({_SPANS}), o AS (SELECT section_id, count(*) FILTER (model <> 'F') AS models FROM s GROUP BY 1), n AS (SELECT section_id, count(*) AS gazetteer FROM s WHERE entity = 'A' GROUP BY 1) SELECT section_id AS source_file, models, gazetteer, models + gazetteer AS total FROM o JOIN n USING (section_id)")
def merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spans(spark, sf_dir).withColumnRenamed("section_id", "source_file")
    return files.merge_counts(s.withColumn("model", F.when(F.col("model") == "F", "OldGazetteer").otherwise(F.col("model"))), s.where("entity = 'A'"))


@register(f"SELECT k, 'paper' || (s.section_id % 7) AS paper_path FROM ({_SPANS}) s UNION ALL SELECT k, 'again' FROM ({_SPANS}) WHERE section_id < 5")
def paper_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spans(spark, sf_dir)
    of = s.select("section_id", F.concat(F.lit("paper"), F.col("section_id") % 7).alias("paper_path"))
    return files.of_papers(s, of.unionByName(of.where("section_id < 5").withColumn("paper_path", F.lit("again")))).select("k", "paper_path")


@register("WITH c AS (SELECT q.vec_id AS id, e.vec_id AS qid, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 4) AS score FROM (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q JOIN embeddings e ON e.label = q.label AND e.vec_id <> q.vec_id) SELECT id, qid, score FROM c WHERE score >= 0.3 QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, qid) = 1")
def similar_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate of the highest cosine among those of a query's label (id % 50 against all rows)."""
    e = _table(spark, sf_dir, "embeddings")
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vector"))
    return enrich.most_similar_within(q, e.select(F.col("vec_id").alias("qid"), "label", F.col("embedding").alias("vector")), "label", 0.3, 4)


@register("WITH a AS (SELECT DISTINCT p_type AS qid, p_brand AS alias FROM part), i AS (SELECT DISTINCT p_type AS qid FROM part UNION SELECT 'none') SELECT qid, CASE WHEN qid = 'none' THEN '' ELSE 'label ' || qid END AS label, coalesce(array_to_string(list(alias ORDER BY alias) FILTER (alias IS NOT NULL), '|'), '') AS aliases FROM i LEFT JOIN a USING (qid) GROUP BY qid")
def alias_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    ids = p.select(F.col("p_type").alias("qid")).unionByName(spark.createDataFrame([("none",)], "qid string"))
    answers = p.select(F.col("p_type").alias("qid"), F.concat(F.lit("label "), "p_type").alias("label"), F.col("p_brand").alias("alias"))
    return enrich.aliases_of(ids, answers).withColumn("aliases", F.array_join("aliases", "|"))


@register("SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'energytype' WHEN p_type = 'SMALL' THEN 'energystorage' ELSE 'energytype' END AS mapped, CASE p_partkey % 3 WHEN 0 THEN 'IRENA' WHEN 1 THEN 'Maritime-Ontology' ELSE 'x.' || lower(p_brand) END AS source FROM part")
def domain_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    kind = F.when(F.col("p_type") == "SMALL", "Storage").when(F.col("p_type") == "PROMO", "").otherwise(F.col("p_type"))
    path = F.when(F.col("p_partkey") % 3 == 0, "a/IRENA-v2.tsv").when(F.col("p_partkey") % 3 == 1, "b/Vessel.tsv").otherwise(F.concat(F.lit("c/x."), F.lower("p_brand"), F.lit(".tsv")))
    return p.select("p_partkey", domains.mention_type(kind, "energy").alias("mapped"), domains.source_of(path).alias("source"))


@register(f"WITH {_MENTIONS} SELECT doc_id, \"start\", CASE WHEN linked_id = 'C4' THEN entity ELSE 'energytype' END AS entity, CASE WHEN linked_id = 'C4' THEN 'Other' ELSE 'EnergyGazetteer' END AS model FROM mention")
def gazetteer_relabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _mentions(spark, sf_dir).withColumn("model", F.when(F.col("linked_id") == "C4", "Other").otherwise(F.col("model")))
    types = _vocab(spark).groupBy("id").agg(F.min_by("type", "ord").alias("type"))
    return spans.relabelled(m, types, "EnergyGazetteer", domains.mention_type(F.col("entry_type"), "energy")).select("doc_id", "start", "entity", "model")


@register(f"WITH {_MENTIONS} SELECT lower(text) AS value, count(*) AS n FROM mention GROUP BY 1 ORDER BY n DESC, value LIMIT 20")
def top_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.value_counts(_mentions(spark, sf_dir).withColumn("text", F.lower("text")), "text", 20)


@register("SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS id, p_name AS concept, p_type AS type, CAST(p_size AS BIGINT) AS freq FROM part JOIN orders ON o_custkey = p_partkey")
def entry_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link.by_id(_table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("id")), _parts(spark, sf_dir))


@register("SELECT (id).id AS query, rank, c AS concept FROM (SELECT struct_pack(id := p_name) AS id, row_number() OVER (PARTITION BY p_name ORDER BY freq DESC, ord, i) AS rank, c FROM (SELECT DISTINCT p_name FROM part) q JOIN (SELECT CAST(p_partkey AS VARCHAR) AS i, p_name AS c, string_split(lower(CAST(p_partkey AS VARCHAR) || ' ' || p_name || ' ' || p_brand), ' ') AS t, CAST(p_size AS BIGINT) AS freq, p_partkey AS ord FROM part) e ON list_has_all(t, string_split(lower(p_name), ' '))) WHERE rank <= 10")
def full_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parts(spark, sf_dir)
    return vocabulary.search(p, p.select(F.col("concept").alias("query")).distinct()).select("query", F.col("rank").cast("long").alias("rank"), "concept")
