"""Reports over mentions: linking by type, unlinked terms and their classes, type comparison, offsets.

Defined results: null texts and terms are counted where they are rows and match nothing; ties fall to the term; an empty
table gives no rows; vocabularies may have repeated entries; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Words too common in disease names to find one by, and terms that name a process, symptom or finding only.
GENERIC = tuple("acute advanced cell chronic early from grade high late like low metastatic primary recurrent secondary stage type with".split())
SKIPPED = ("death", "disease", "disorder", "fatigue", "fever", "illness", "infection", "inflammation", "lesion", "lesions", "mass", "metastasis", "nausea", "nodule", "pain", "syndrome", "toxicity", "tumor", "tumors")


def type_stats(mentions: DataFrame) -> DataFrame:
    made = mentions.groupBy(F.lower("entity").alias("entity")).agg(F.count("*").alias("total"), F.countDistinct(F.lower("text")).alias("distinct_mentions"), F.count_if(F.col("linked_id").isNotNull()).alias("linked"))
    return made.withColumn("unlinked", F.col("total") - F.col("linked")).withColumn("linked_pct", F.round(100.0 * F.col("linked") / F.col("total"), 4))


def top_unlinked(mentions: DataFrame, n: int = 250) -> DataFrame:
    return mentions.where("linked_id is null").groupBy(F.lower(F.trim("text")).alias("term")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(n)


def known_terms(terms: DataFrame, vocab: DataFrame) -> DataFrame:
    """``terms`` that are a concept or one of the ``|``-parted synonyms of an entry, case aside."""
    names = vocab.select(F.explode(F.concat(F.array("concept"), F.split(F.coalesce("synonyms", F.lit("")), r"\|"))).alias("t"))
    keys = names.select(F.lower(F.trim("t")).alias("_t")).where("_t <> ''").distinct()
    return terms.withColumn("_t", F.lower(F.trim("term"))).join(keys, "_t", "left_semi").drop("_t")


def keywords(term: Column) -> Column:
    """A term's first two words of more than three letters that aren't generic."""
    words = F.regexp_extract_all(F.lower(term), F.lit(r"(?U)\b\w+\b"), F.lit(0))
    return F.slice(F.filter(words, lambda w: (F.length(w) > 3) & ~w.isin(*GENERIC)), 1, 2)


def candidates(terms: DataFrame, vocab: DataFrame, most: int = 5) -> DataFrame:
    """(term, id, concept, rank): up to ``most`` entries whose concept holds one of the term's keywords.

    ``vocab``: id, concept, ord. The first keyword's entries come first, then load order. A keyword and a concept that
    holds it share the keyword's first four letters: an equi-join on these leaves few pairs to look at. Entries of one
    concept are held by the same keywords, so only the first ``most`` of each concept go into it.
    """
    asked = terms.select("term").distinct().select("term", F.posexplode(keywords(F.col("term"))).alias("k", "word"))
    words = asked.select("word", F.substring("word", 1, 4).alias("g")).distinct()
    low = F.lower("concept")
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(low) - 3), lambda i: F.substring(low, i, F.lit(4))))
    same = Window.partitionBy(low).orderBy("ord", "id")
    heads = vocab.where(F.length("concept") > 3).select("id", "concept", "ord").withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= most)
    entries = heads.select("id", "concept", "ord", F.explode(grams).alias("g"))
    held = words.join(entries, "g").where(F.lower("concept").contains(F.col("word"))).drop("g")
    first = Window.partitionBy("word").orderBy("ord", "id")
    few = held.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= most).drop("_n")
    each = asked.join(few, "word").groupBy("term", "id", "concept").agg(F.min(F.struct("k", "ord")).alias("at"))
    w = Window.partitionBy("term").orderBy("at", "id")
    return each.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most).drop("at")


def classify_unlinked(terms: DataFrame, vocab: DataFrame, skipped: tuple[str, ...] = SKIPPED) -> DataFrame:
    """``terms`` (term, n) with class: SKIP (a term that names no disease), ABBREV (up to five letters and digits, hyphens
    aside), SYNONYM (an entry holds a keyword), MISSING (cancers and syndromes), UNKNOWN."""
    hits = candidates(terms, vocab, 1).select("term").distinct().withColumn("_hit", F.lit(True))
    t = F.lower("term")
    short = (F.length("term") <= 5) & F.replace("term", F.lit("-"), F.lit("")).rlike(r"^[\p{L}\p{N}]+$")
    shouted = (F.length("term") <= 5) & (F.col("term") == F.upper("term")) & (F.col("term") != t)
    kind = F.when(t.isin(*skipped), "SKIP").when(short | shouted, "ABBREV").when(F.col("_hit"), "SYNONYM").when(t.contains("cancer") | t.contains("carcinoma") | t.contains("syndrome"), "MISSING").otherwise("UNKNOWN")
    return terms.join(hits, "term", "left").select(*terms.columns, kind.alias("class"))


def unlinked_report(mentions: DataFrame, vocab: DataFrame, n: int = 500) -> DataFrame:
    """(class, terms, mentions, share) of the ``n`` commonest unlinked terms that aren't in the vocabulary after all.

    The class with most mentions comes first; ``share`` is of all unlinked mentions.
    """
    every = mentions.where("linked_id is null").groupBy(F.lower(F.trim("text")).alias("term")).agg(F.count("*").alias("n"))
    total = every.agg(F.sum("n").alias("total"))
    top = every.orderBy(F.desc("n"), "term").limit(n)
    known = known_terms(top, vocab).select("term")
    classed = classify_unlinked(top.join(known, "term", "left_anti"), vocab)
    made = classed.groupBy("class").agg(F.count("*").alias("terms"), F.sum("n").alias("mentions"))
    return made.join(F.broadcast(total), F.lit(True)).select("class", "terms", "mentions", F.round(F.col("mentions") / F.col("total"), 6).alias("share")).orderBy(F.desc("mentions"), "class")


def inspect_offsets(mentions: DataFrame, sections: DataFrame) -> DataFrame:
    """Mentions with what their section reads at their span (found) and whether that is the mention, case aside."""
    body = sections.select("section_id", F.col("text").alias("_body"))
    found = F.when((F.col("start") >= 0) & (F.col("end") <= F.length("_body")), F.substring(F.col("_body"), F.col("start") + 1, F.col("end") - F.col("start")))
    joined = mentions.join(body, "section_id", "left").withColumn("found", found).drop("_body")
    return joined.withColumn("holds", F.coalesce(F.lower("found") == F.lower("text"), F.lit(False)))


def observed(frame: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """``frame`` and an observation of its rows and the given conditions, filled when the frame is first run."""
    watch = Observation(name)
    return frame.observe(watch, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(k) for k, c in counts.items()]), watch


def compare_types(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer comparison of two type columns (type), on trimmed lower case, with counts and status."""
    count = lambda f, n: f.where("type is not null").groupBy(F.lower(F.trim("type")).alias("type")).agg(F.count("*").alias(n))
    both = count(left, "mentions").join(count(right, "entries"), "type", "full_outer")
    return both.withColumn("status", F.when(F.col("entries").isNull(), "mentions only").when(F.col("mentions").isNull(), "vocabulary only").otherwise("matched"))
