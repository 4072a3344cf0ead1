"""Annotation samples from linked mentions: extraction with context, selection, enrichment, checks.

Defined results: mentions outside their section's text, or that read otherwise there, give no sample; sections with a
null or empty text have none; ties of selection fall to the sample's id; repeated ids are one sample where it says so;
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions import text as T
from quillspark.operators.filters import offsets_hold
from quillspark.operators.sampling import capped, draw

UNLINKED = "[UNLINKED]"


def of_type(mentions: DataFrame, kind: str | None) -> DataFrame:
    """Mentions of one type, case aside; all without one."""
    return mentions if kind is None else mentions.where(F.lower("entity") == kind.lower())


def sentence_at(text: Column, start: Column, end: Column, reach: int = 100) -> Column:
    """The sentence that holds the span wholly, else the text up to ``reach`` characters round it; stripped.

    Sentences end after ``.``, ``!`` or ``?`` and blanks.
    """
    parts = F.regexp_extract_all(text, F.lit(r"(?s).+?(?:[.!?](?=\s)|$)\s*"), F.lit(0))
    begin = F.struct(F.lit(0).alias("at"), F.lit(None).cast("string").alias("found"))
    folded = F.aggregate(parts, begin, lambda acc, s: F.struct((acc["at"] + F.length(s)).alias("at"), F.when(acc["found"].isNull() & (acc["at"] <= start) & (end <= acc["at"] + F.length(F.rtrim(s))), s).otherwise(acc["found"]).alias("found")))
    low = F.greatest(F.lit(0), start - reach)
    return T.strip(F.coalesce(folded["found"], F.substring(text, low + 1, F.least(F.length(text), end + reach) - low)))


def samples(mentions: DataFrame, sections: DataFrame, sentences: bool = True) -> DataFrame:
    """One row a mention that its section's text bears out, with its links and context.

    ``mentions``: section_id, start, end, text, entity, model, linking (array of source, id, name) and source_file.
    """
    found = mentions.join(sections.where("text <> ''").select("section_id", F.col("text").alias("_body")), "section_id")
    held = found.where(offsets_hold("_body", "start", "end", "text"))
    first, second = (F.try_element_at("linking", F.lit(k)) for k in (1, 2))
    linked = F.coalesce(F.size("linking") > 0, F.lit(False))
    wiki = F.coalesce(linked & (second["source"] == "Wikidata"), F.lit(False))
    none = F.lit("")
    context = sentence_at(F.col("_body"), F.col("start"), F.col("end")) if sentences else sentence_at(F.lit(""), F.col("start"), F.col("end"))
    return held.select(
        T.sample_id(F.col("section_id"), F.col("start"), F.col("end")).alias("id"), F.col("text").alias("mention"), context.alias("context"), F.coalesce("model", F.lit("unknown")).alias("linking_model"),
        F.when(linked, F.coalesce(first["id"], none)).otherwise(UNLINKED).alias("linked_to_concept_id"), F.when(linked, F.coalesce(first["name"], none)).otherwise("").alias("linked_to_name"), F.col("entity").alias("entity_type"),
        F.when(wiki, F.coalesce(second["id"], none)).otherwise("").alias("linked_to_wikidata_id"), F.when(wiki, F.coalesce(second["name"], none)).otherwise("").alias("linked_to_wikidata_name"), "source_file", linked.alias("is_linked"), "section_id", "start", "end",
    )


def two_level(frame: DataFrame, group: str, key: str, n: int, per_mention: int = 3, seed: int = 42, text: str = "mention") -> DataFrame:
    """max(1, n // groups) rows of each ``group``, at most ``per_mention`` of each mention in it, topped up alike to ``n``."""
    named = frame.withColumn("text", F.col(text)) if text != "text" else frame
    groups = max(1, named.select(group).distinct().count())
    w = Window.partitionBy(group, F.lower("text")).orderBy(draw(seed, key), key)
    some = named.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= per_mention)
    order = Window.partitionBy(group).orderBy(draw(seed, key), key)
    ranked = some.withColumn("_n", F.row_number().over(order)).withColumn("_more", F.col("_n") > max(1, n // groups))
    return ranked.orderBy("_more", draw(seed, key), key).limit(n).select(*frame.columns)


def sequential(frame: DataFrame, order: list[str], n_linked: int = 240, n_unlinked: int = 60, per_mention: int = 2) -> DataFrame:
    """The first linked and unlinked rows in ``order`` (id, mention, is_linked), at most ``per_mention`` of each mention.

    Ids are taken once. A row counts towards its mention's limit only if its class still had room, as in a scan. Until
    the first class is full every row of a mention counts, so plain ranks tell what is taken; after that only the other
    class's rows do, ranked on from what their mention has used.
    """
    pos = F.struct(*order, "id")
    own = Window.partitionBy("id").orderBy(*order)
    once = frame.withColumn("_n", F.row_number().over(own)).where("_n = 1").drop("_n").withColumn("_m", F.lower("mention")).withColumn("_pos", pos)
    by = Window.partitionBy("_m").orderBy("_pos")
    taken = once.withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= per_mention).drop("_n")
    room = {True: n_linked, False: n_unlinked}
    full = {}
    for kind, n in room.items():
        last = taken.where(F.col("is_linked") == kind).orderBy("_pos").limit(n).agg(F.count("*").alias("n"), F.max("_pos").alias("pos")).first()
        if last["n"] >= n:
            full[kind] = last["pos"] if n else None
    if not full:
        return taken.select(*frame.columns)
    kind = min(full, key=lambda k: (full[k] is not None, tuple(full[k] or ())))
    at = full[kind]
    cut = F.struct(*[F.lit(v).cast(once.schema["_pos"].dataType[c].dataType).alias(c) for c, v in zip((*order, "id"), at)]) if at is not None else None
    before = taken.where(F.col("_pos") <= cut) if at is not None else taken.where(F.lit(False))
    used = before.groupBy("_m").agg(F.count("*").alias("_used"))
    later = once.where((F.col("is_linked") != kind) & ((F.col("_pos") > cut) if at is not None else F.lit(True)))
    ranked = later.withColumn("_n", F.row_number().over(by)).join(used, "_m", "left").where(F.col("_n") + F.coalesce("_used", F.lit(0)) <= per_mention)
    left = max(0, room[not kind] - before.where(F.col("is_linked") != kind).count())
    return before.select(*frame.columns).unionByName(ranked.orderBy("_pos").limit(left).select(*frame.columns))


def link_score(linking: Column, ident: Column) -> Column:
    """The score of the link with an id, else of the first link, else null."""
    with_id = F.try_element_at(F.filter(linking, lambda x: x["id"] == ident), F.lit(1))
    return F.coalesce(F.when(with_id.isNotNull(), with_id["score"]).otherwise(F.try_element_at(linking, F.lit(1))["score"]))


#: Words of an entry type that name a mention type where no map does: the rule's words, and the types they stand for.
KEYWORDS = ((("automation",), ("automation technologies",)), (("equipment", "sensor"), ("sensor types",)), (("communication", "connectivity"), ("entity connection types", "communication types")), (("user", "social"), ("vru types",)), (("vehicle",), ("vehicle types",)))


def type_check(entity: Column, entry_type: Column, mappings: dict[str, dict[str, list[str]]], domain: str, categories: dict[str, list[str]] | None = None, keywords=()) -> Column:
    """yes, no or na: whether a mention's type is one that its entry's type stands for.

    The domain's mapping is looked at first, then the others'; then, in a domain with ``categories``, the first of
    several categories and ``keywords``; then the type itself, case aside. Missing types are na.
    """
    kind = F.trim(entry_type)
    listed = lambda types: F.array(*[F.lit(t.lower()) for t in types])
    rules: list[tuple[Column, Column]] = []
    for name in [domain, *(m for m in mappings if m != domain)]:
        rules += [(kind == k, listed(v)) for k, v in mappings.get(name, {}).items()]
    if categories:
        lead = F.trim(F.substring_index(kind, "|", 1))
        rules += [(kind.contains("|") & (lead == k), listed(v)) for k, v in categories.items()]
    low = F.lower(kind)
    for words, types in keywords:
        hit = low.contains(words[0])
        for w in words[1:]:
            hit = hit | low.contains(w)
        rules.append((hit, listed(types)))
    expected = F.array(low)
    for condition, value in reversed(rules):
        expected = F.when(condition, value).otherwise(expected)
    missing = (F.coalesce(entity, F.lit("")) == "") | (F.coalesce(entry_type, F.lit("")) == "")
    return F.when(missing, "na").when(F.array_contains(expected, F.lower(F.trim(entity))), "yes").otherwise("no")


def enriched(found: DataFrame, mentions: DataFrame, types: DataFrame, check: Column) -> DataFrame:
    """Samples with score_ner, score_el, taxonomy_type and type_match.

    The sample's mention is that of its section and span, within one character where none is exact, with the same text;
    ``types`` (id, type) gives the entry's type; ``check`` is made of entity_type and taxonomy_type.
    """
    m = mentions.select("section_id", F.col("start").alias("_a"), F.col("end").alias("_b"), F.lower("text").alias("_t"), F.col("score").alias("_s"), "linking")
    shifts = F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)]))
    probes = found.select("id", "section_id", "start", "end", F.lower("mention").alias("_t"), "linked_to_concept_id", shifts.alias("_k")).withColumn("_a", F.col("start") + F.col("_k"))
    hit = probes.join(m, ["section_id", "_a", "_t"]).where(F.abs(F.col("_b") - F.col("end")) <= 1)
    tier = F.when((F.col("_k") == 0) & (F.col("_b") == F.col("end")), 1).otherwise(2)
    best = hit.groupBy("id").agg(F.min_by(F.struct(F.col("_s").alias("score_ner"), link_score(F.col("linking"), F.col("linked_to_concept_id")).alias("score_el")), F.struct(tier, "_a", "_b", "_s")).alias("_m"))
    kinds = types.where("type <> ''").groupBy(F.col("id").alias("linked_to_concept_id")).agg(F.max("type").alias("taxonomy_type"))
    return found.join(best, "id", "left").join(kinds, "linked_to_concept_id", "left").select(*found.columns, "_m.score_ner", "_m.score_el", F.coalesce("taxonomy_type", F.lit("")).alias("taxonomy_type")).withColumn("type_match", check)


def summary(rows: DataFrame) -> DataFrame:
    """Counts of an enrichment: samples, those with a recogniser's and a linker's score, with a type, and the checks."""
    one = lambda c, n: F.count_if(c).alias(n)
    return rows.agg(F.count("*").alias("samples"), F.count("score_ner").alias("with_score_ner"), F.count("score_el").alias("with_score_el"), one(F.col("taxonomy_type") != "", "with_type"), *[one(F.col("type_match") == k, k) for k in ("yes", "no", "na")])


def capped_by_mention(frame: DataFrame, key: str, per_mention: int, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows with at most ``per_mention`` of each lower-cased mention."""
    return capped(frame.withColumn("text", F.col("mention")), key, per_mention, n, seed).drop("text")
