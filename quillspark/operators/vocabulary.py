"""Vocabulary frames: terms, exact-lookup tables, patches, converters and types.

A vocabulary row has id, concept, synonyms, type, freq and ord (load order); every tie falls to ord.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import ascii_lower, strip


def blank_to_null(c: Column) -> Column:
    return F.when(strip(c) != "", c)


def aliases(*columns: str) -> Column:
    """The non-empty alias columns as one text, parted by `` | ``."""
    return F.concat_ws(" | ", *(blank_to_null(F.col(c)) for c in columns))


def pieces(c: Column, separator: str) -> Column:
    """Trimmed non-empty parts of a multi-valued text."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), separator), strip), lambda x: x != "")


def lookup_entities(vocab: DataFrame) -> DataFrame:
    """One row per id: the first loaded. Rows without id or concept are left out; a broken frequency is 0."""
    rows = vocab.where((strip(F.coalesce("id", F.lit(""))) != "") & (strip(F.coalesce("concept", F.lit(""))) != ""))
    freq = F.coalesce(F.col("freq").cast("string").try_cast("long"), F.lit(0)).alias("freq")
    first = rows.groupBy("id").agg(F.min_by(F.struct("concept", "type", freq, "ord"), "ord").alias("e"))
    return first.select("id", "e.*")


def lookup_synonyms(vocab: DataFrame) -> DataFrame:
    """(key, id): lower-cased synonyms of all rows - those of later duplicates of an id too - but the concept's own."""
    rows = vocab.where((strip(F.coalesce("id", F.lit(""))) != "") & (strip(F.coalesce("concept", F.lit(""))) != ""))
    made = rows.select("id", F.lower("concept").alias("_c"), F.explode(pieces(F.col("synonyms"), r"\|")).alias("s"))
    return made.where(F.lower("s") != F.col("_c")).select(F.lower("s").alias("key"), "id").distinct()


def lookup(vocab: DataFrame) -> DataFrame:
    """(key, strategy, id, concept, type, freq, ord): strategy 0 a concept, folded in ASCII; 1 a synonym."""
    e = lookup_entities(vocab)
    concepts = e.select(ascii_lower(F.col("concept")).alias("key"), F.lit(0).alias("strategy"), "id", "concept", "type", "freq", "ord")
    synonyms = lookup_synonyms(vocab).join(e, "id").select("key", F.lit(1).alias("strategy"), "id", "concept", "type", "freq", "ord")
    return concepts.unionByName(synonyms)


def token_index(vocab: DataFrame) -> DataFrame:
    """(token, id): the words of id, concept and synonyms, for full-text search."""
    words = F.regexp_extract_all(F.lower(F.concat_ws(" ", "id", "concept", "synonyms")), F.lit(r"(?U)\w+"), F.lit(0))
    return lookup_entities(vocab).select("id").join(vocab.select("id", F.explode(F.array_distinct(words)).alias("token")), "id").distinct().select("token", "id")


def search(vocab: DataFrame, queries: DataFrame, limit: int = 10) -> DataFrame:
    """(query, id, concept, freq) of entries that hold all words of a query, most frequent first, ``limit`` each."""
    asked = queries.select("query", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("query"), F.lit(r"(?U)\w+"), F.lit(0)))).alias("token"))
    need = asked.groupBy("query").agg(F.count("*").alias("need"))
    hit = asked.join(token_index(vocab), "token").groupBy("query", "id").agg(F.count("*").alias("n")).join(need, "query").where("n = need")
    from pyspark.sql.window import Window

    w = Window.partitionBy("query").orderBy(F.desc("freq"), "ord", "id")
    return hit.join(lookup_entities(vocab), "id").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).select("query", "id", "concept", "freq", "rank")


def patch(vocab: DataFrame, additions: DataFrame) -> DataFrame:
    """``vocab`` with new synonyms (id, add array) appended in order at an id's first row, those it has left out."""
    firsts = vocab.groupBy("id").agg(F.min("ord").alias("ord"))
    new = firsts.join(additions, "id").select("id", "ord", "add")
    joined = vocab.join(new, ["id", "ord"], "left")
    has = pieces(F.col("synonyms"), r"\|")
    lower = F.transform(has, F.lower)
    extra = F.filter(F.coalesce("add", F.array().cast("array<string>")), lambda x: ~F.array_contains(lower, F.lower(x)))
    return joined.withColumn("synonyms", F.when(F.size(extra) > 0, F.array_join(F.concat(has, extra), "|")).otherwise(F.col("synonyms"))).select(*vocab.columns)


def patch_misses(vocab: DataFrame, additions: DataFrame) -> DataFrame:
    return additions.join(vocab.select("id"), "id", "left_anti").select("id")


def gazetteer_terms(vocab: DataFrame, alias_columns: tuple[str, ...] = ("synonyms",)) -> DataFrame:
    """(term, id, concept, type, ord, at) of concepts and aliases, as the matcher takes them; ``at`` orders overwrites."""
    parts = F.concat(F.array("concept"), pieces(aliases(*alias_columns), r" \| "))
    return vocab.where("concept is not null").select("id", "concept", "type", "ord", F.posexplode(parts).alias("k", "term")).select("term", "id", "concept", "type", "ord", F.struct("ord", "k").alias("at"))


def centroids(vectors: DataFrame, key: str, vector: str, digits: int | None = None) -> DataFrame:
    """Mean vector by key. Means aren't normalised again."""
    each = vectors.select(key, F.posexplode(vector).alias("d", "x")).groupBy(key, "d").agg(F.avg("x").alias("m"))
    value = F.round("m", digits) if digits is not None else F.col("m")
    return each.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", value.alias("m")))), lambda s: s["m"]).alias("centroid"))


def rich_document(concept: str = "concept", description: str = "description", synonyms: str = "aliases") -> Column:
    """``concept. description. Also known as: a, b`` for embedding."""
    known = F.array_join(pieces(F.col(synonyms), r" \| "), ", ")
    return F.concat_ws(". ", F.col(concept), blank_to_null(F.col(description)), F.when(known != "", F.concat(F.lit("Also known as: "), known)))


def type_map(vocab: DataFrame) -> DataFrame:
    """(id, type): non-empty types, the last row of an id."""
    return vocab.where(strip(F.coalesce("type", F.lit(""))) != "").groupBy("id").agg(F.max_by("type", "ord").alias("type"))


def gene_rows(csv: DataFrame) -> DataFrame:
    own = F.when(F.lower("Description") != F.lower("Symbol"), blank_to_null(F.col("Description")))
    return csv.where(F.coalesce("Symbol", F.lit("")) != "").select(F.concat(F.lit("NCBI:"), "GeneID").alias("id"), F.col("Symbol").alias("concept"), F.concat_ws("|", blank_to_null(F.col("Synonyms")), own).alias("synonyms"), F.lit("Gene").alias("type"), F.lit("False").alias("top_level"), F.col("Type_of_gene").alias("type_of_gene"), F.col("Organism").alias("organism"), F.col("Organism_ID").alias("organism_id"))


def species_rows(csv: DataFrame) -> DataFrame:
    prefixed = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit("NCBI:"), c)).otherwise("")
    return csv.where((F.coalesce("term", F.lit("")) != "") & (F.coalesce("id", F.lit("")) != "")).select(prefixed("id").alias("id"), F.col("term").alias("concept"), "synonyms", prefixed("parent_id").alias("parent_id"), F.lit("Species").alias("type"), "rank", "variants", "freq")


def disease_rows(csv: DataFrame) -> DataFrame:
    return csv.where((F.coalesce("id", F.lit("")) != "") & (F.coalesce("name", F.lit("")) != "")).select(F.when(F.col("id").startswith("DOID:"), F.col("id")).otherwise(F.concat(F.lit("DOID:"), "id")).alias("id"), F.col("name").alias("concept"), "synonyms", F.lit("Disease").alias("type"), F.coalesce(blank_to_null(F.col("description")), F.col("def"), F.lit("")).alias("description"), "suggestions")
