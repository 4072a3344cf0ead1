"""Linking: exact lookup with spelling variants, first-use memo, vector top-k with fallbacks, type checks, prompts.

Defined results: null and blank texts link to nothing and stay; repeated mentions are linked each; ties fall to load
order, then id; an empty table or vocabulary gives no links; names that begin with an underscore are the functions' own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.window import Window

from quillspark.functions.text import answer_choice, strip, variants
from quillspark.operators.nearest import nearest_in_block
from quillspark.operators.vocabulary import lookup, lookup_entities
from quillspark.plans.shared import written


def exact(mentions: DataFrame, vocab: DataFrame, by_type: bool = False) -> DataFrame:
    """``mentions`` (text, entity, ...) with linked_id, linked_name, frequency, linked_type of their best entry or nulls.

    Distinct mention texts are looked up once (and joined back): their variants in order, a concept before a synonym,
    the most frequent entry, then load order and id. ``by_type`` looks only at entries of the mention's type.
    """
    keys = ["_text", "_type"] if by_type else ["_text"]
    made = mentions.withColumn("_text", strip(F.col("text"))).withColumn("_type", F.lower("entity"))
    asked = made.where("_text <> ''").select(*keys).distinct()
    probes = asked.select("*", F.posexplode(variants(F.col("_text"))).alias("variant", "probe")).withColumn("key", F.lower("probe"))
    table = lookup(vocab)
    on = ["key"]
    if by_type:
        table, on = table.withColumn("_type", F.lower("type")), ["key", "_type"]
    best = probes.join(table, on).groupBy(*keys).agg(F.min_by(F.struct("id", "concept", "freq", "type"), F.struct("variant", "strategy", -F.col("freq"), "ord", "id")).alias("b"))
    joined = made.join(best, keys, "left")
    return joined.select(*mentions.columns, F.col("b.id").alias("linked_id"), F.col("b.concept").alias("linked_name"), F.when(F.col("b.freq") > 0, F.col("b.freq")).alias("frequency"), F.col("b.type").alias("linked_type"))


def all_matches(mentions: DataFrame, vocab: DataFrame, limit: int = 10) -> DataFrame:
    """(text, id, concept, freq, rank): every entry that a text's lower-cased form names, most frequent first."""
    asked = mentions.select("text", F.lower(strip(F.col("text"))).alias("key")).distinct()
    found = asked.join(lookup(vocab), "key").groupBy("text", "id").agg(F.first("concept").alias("concept"), F.max("freq").alias("freq"), F.min("ord").alias("ord"))
    w = Window.partitionBy("text").orderBy(F.desc("freq"), "ord", "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).drop("ord")


def by_id(ids: DataFrame, vocab: DataFrame) -> DataFrame:
    """(id, concept, type, freq) of the asked ids (id) that have an entry: their first loaded row."""
    return ids.select("id").distinct().join(lookup_entities(vocab), "id").select("id", "concept", "type", "freq")


def first_uses(mentions: DataFrame, order: list[str], key: Column | None = None) -> DataFrame:
    """One row per lower-cased mention text: its first in ``order``; a memo to link once and join back."""
    k = F.lower("text") if key is None else key
    cols = [c for c in mentions.columns]
    return mentions.withColumn("key", k).groupBy("key").agg(F.min(F.struct(*order, *[c for c in cols if c not in order])).alias("m")).select("key", "m.*")


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def _scored(queries: DataFrame, entries: DataFrame, digits: int) -> DataFrame:
    """Every query against every entry; the smaller entry side is broadcast, its size checked by the caller."""
    e = F.broadcast(entries.select("entry", F.col("vector").alias("_v")))
    return queries.select("query", "vector").join(e, F.lit(True)).select("query", "entry", F.round(dot("vector", "_v"), digits).alias("score"))


def _slices(entries: DataFrame, most_bytes: int) -> list[DataFrame]:
    """``entries`` in parts of about ``most_bytes`` bytes, by the count of rows and of the widest vector's numbers."""
    n, width = entries.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    parts = max(1, -(-n * (8 * width + 32) // most_bytes))
    return [entries] if parts == 1 else [entries.where(F.pmod(F.xxhash64("entry"), F.lit(parts)) == s) for s in range(parts)]


def _parts(rows: int, width: int, most_bytes: int, cores: int) -> int:
    """Blocks of at most about ``most_bytes``, and for many rows enough of them that all cores have some."""
    return max(1, -(-rows * (8 * width + 32) // most_bytes), min(2 * cores, rows // 2048))


def nearest(queries: DataFrame, entries: DataFrame, k: int, digits: int, most_bytes: int = 16 << 20, within: str | None = None, cosine: bool = False, others: bool = False) -> DataFrame:
    """(query, entry, score, rank): by query (query, vector) the ``k`` entries (entry, vector) of highest dot product or cosine.

    ``within`` names a column that must be equal, ``others`` leaves out a query's own id and null scores. Rows are spread over
    blocks of bounded size by hash, every block of queries meets every block of entries in a task, and each such pair
    gives its own top k, merged by a last ranking: no table is broadcast or brought to the driver.
    """
    cores = entries.sparkSession.sparkContext.defaultParallelism
    n, width = entries.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    e_parts, q_parts = _parts(n, width, most_bytes, cores), max(1, -(-queries.count() * (8 * width + 32) // most_bytes))
    group = F.col(within) if within else F.lit(0)
    place = lambda c, parts: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    cell = (F.col("_e") * q_parts + F.col("_q")).alias("_cell")
    asked = queries.select("query", F.col("vector").alias("q_vector"), group.alias("_group"), place("query", q_parts).alias("_q"), every(e_parts).alias("_e")).select(cell, "query", "q_vector", "_group")
    there = entries.select("entry", F.col("vector").alias("e_vector"), group.alias("_group"), place("entry", e_parts).alias("_e"), every(q_parts).alias("_q")).select(cell, "entry", "e_vector", "_group")
    made = StructType([StructField("query", queries.schema["query"].dataType), StructField("entry", entries.schema["entry"].dataType), StructField("score", DoubleType())])
    nothing = to_arrow_schema(made).empty_table()  # a cell without rows of one side comes without columns
    run = lambda q, e: nearest_in_block(q, e, k, digits, cosine, others) if q.num_rows and e.num_rows else nothing
    side = lambda f: f.repartition(e_parts * q_parts, "_cell").groupBy("_cell")
    each = side(asked).cogroup(side(there)).applyInArrow(run, made)
    w = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    return each.withColumn("score", F.round("score", digits)).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(queries: DataFrame, entries: DataFrame, k: int = 7, digits: int = 6, most_bytes: int = 16 << 20) -> DataFrame:
    """(query, entry, score, rank): the ``k`` entries (entry, vector) of highest dot product by query (query, vector).

    A stated query set against all entries, exactly, in blocks (``nearest``). Scores are rounded, ties go to the lower
    entry; null vectors score null and come last.
    """
    return nearest(queries, entries, k, digits, most_bytes)


def with_fallbacks(candidates: DataFrame, queries: DataFrame, fallbacks: DataFrame, digits: int = 6, most_bytes: int = 64 << 20) -> DataFrame:
    """``candidates`` of ``top_k`` and, ranked after them, the fallback entries that they lack, with their own scores."""
    candidates = written(candidates)  # read three times below
    scored = reduce(DataFrame.unionByName, [_scored(queries, part, digits) for part in _slices(fallbacks, most_bytes)])
    lacking = scored.join(candidates.select("query", "entry"), ["query", "entry"], "left_anti")
    last = candidates.groupBy("query").agg(F.max("rank").alias("_last"))
    w = Window.partitionBy("query").orderBy("entry")
    more = lacking.join(last, "query", "left").select("query", "entry", "score", (F.coalesce("_last", F.lit(0)) + F.row_number().over(w)).alias("rank"))
    return candidates.unionByName(more)


def best_above(candidates: DataFrame, threshold: float) -> DataFrame:
    return candidates.where((F.col("rank") == 1) & (F.col("score") >= threshold)).drop("rank")


def choose(candidates: DataFrame, answers: DataFrame, threshold: float, strict: bool = False) -> DataFrame:
    """The candidate that a reranker's answer (query, answer) picks, where the first one reaches ``threshold``."""
    first = candidates.where((F.col("rank") == 1) & (F.col("score") >= threshold)).select("query")
    n = candidates.groupBy("query").agg(F.max("rank").alias("n"))
    picked = answers.join(first, "query").join(n, "query").withColumn("rank", answer_choice(F.col("answer"), F.col("n"), strict)).where("rank is not null").select("query", "rank")
    return candidates.join(picked, ["query", "rank"])


def types_agree(entry_type: Column, entity: Column, mapping: dict[str, list[str]]) -> Column:
    """Whether a mention's type is among those that its entry's type maps to (itself if unmapped); none: it is."""
    low = F.lower(entry_type)
    expected = F.array(low)
    for k, v in mapping.items():
        expected = F.when(low == k.lower(), F.array(*[F.lit(x.lower()) for x in v])).otherwise(expected)
    return F.when(entry_type.isNull() | (strip(entry_type) == ""), True).otherwise(F.array_contains(expected, F.lower(entity)))


def reject_mismatches(mentions: DataFrame, mapping: dict[str, list[str]]) -> DataFrame:
    """Linked mentions whose types disagree lose their link and carry type_mismatch."""
    bad = F.col("linked_id").isNotNull() & ~types_agree(F.col("linked_type"), F.col("entity"), mapping)
    keep = [F.when(~bad, F.col(c)).alias(c) if c in ("linked_id", "linked_name", "frequency") else F.col(c) for c in mentions.columns]
    return mentions.select(*keep, bad.alias("type_mismatch"))


def link_array(source: Column, ident: Column, name: Column, wikidata: Column | None = None) -> Column:
    """``linking``: the vocabulary's link and, if there is one, the Wikidata link."""
    none = F.lit(None)
    one = lambda s, i: F.struct(s.alias("source"), i.alias("id"), name.alias("name"), none.cast("double").alias("score"), none.cast("long").alias("frequency"))
    links = [F.when(ident.isNotNull(), one(source, ident))]
    if wikidata is not None:
        links.append(F.when(strip(wikidata) != "", one(F.lit("Wikidata"), F.substring_index(wikidata, "/", -1))))
    return F.array_compact(F.array(*links))


def prompt(mention: Column, context: Column, names: Column) -> Column:
    """A reranker's prompt: the mention marked in its context, and the numbered candidates."""
    marked = F.replace(context, mention, F.concat(F.lit(">>>"), mention, F.lit("<<<")))
    listed = F.array_join(F.transform(names, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
    return F.concat(F.lit("Mention: "), mention, F.lit("\nContext: "), marked, F.lit("\nCandidates:\n"), listed, F.lit("\nAnswer with one number, or REJECT."))


def hierarchy_marks(candidates: DataFrame) -> DataFrame:
    """``candidates`` (query, entry, parent, rank) with marker: ``see n`` if the parent is candidate n, BROAD if it is a
    parent of another candidate, else SPECIFIC."""
    parents = candidates.select("query", F.col("entry").alias("parent"), F.col("rank").alias("_at"))
    seen = candidates.join(parents, ["query", "parent"], "left")
    broad = candidates.where("parent is not null").select("query", F.col("parent").alias("entry"), F.lit(True).alias("_broad")).distinct()
    marked = seen.join(broad, ["query", "entry"], "left")
    return marked.withColumn("marker", F.when(F.col("_at").isNotNull(), F.concat(F.lit("see "), F.col("_at").cast("string"))).when(F.col("_broad"), "BROAD").otherwise("SPECIFIC")).drop("_at", "_broad")


def contexts(mentions: DataFrame, window: int = 5, most: int = 3) -> DataFrame:
    """``mentions`` (text, section text) with ``contexts``: up to ``most`` distinct token windows round the mention."""
    toks = F.split(F.lower("section"), r"(?U)\s+")
    want = F.split(F.lower("text"), r"(?U)\s+")
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("_t") - F.size("_w") + 1)), lambda i: F.slice("_t", i, F.size("_w")) == F.col("_w"))
    windows = F.transform(starts, lambda i: F.array_join(F.slice("_t", F.greatest(F.lit(1), i - window), F.size("_w") + window + F.least(F.lit(window), i - 1)), " "))
    return mentions.withColumn("_t", toks).withColumn("_w", want).withColumn("contexts", F.slice(F.array_distinct(windows), 1, most)).drop("_t", "_w")


def sentence_contexts(mentions: DataFrame, most: int = 3) -> DataFrame:
    """``mentions`` (text, section text) with ``contexts``: up to ``most`` distinct sentences that hold the mention, case aside.

    Sentences end after ``.``, ``!`` or ``?`` and blanks; null and blank mentions have none.
    """
    parts = F.transform(F.split(F.regexp_replace("section", r"(?U)([.!?])\s+", "$1\u0001"), "\u0001"), strip)
    held = F.filter(parts, lambda s: (s != "") & F.lower(s).contains(F.lower(strip(F.col("text")))))
    found = F.when(strip(F.col("text")) != "", F.slice(F.array_distinct(held), 1, most))
    return mentions.withColumn("contexts", F.coalesce(found, F.array().cast("array<string>")))
