"""Span algebra on flat mention rows (section_id, start, end, ...): offsets are code points, half open.

Defined results: empty tables give empty tables; repeated rows stay, or merge with each other; null types and models never
merge; other columns are kept, but names that begin with an underscore are the functions' own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def without_overlaps(mentions: DataFrame, kept: DataFrame, section: str = "section_id") -> DataFrame:
    """Rows of ``mentions`` that overlap no row of ``kept`` in their section (spans are not empty).

    A sweep by position: a mention overlaps if, of the kept spans that begin before its end, the furthest end lies beyond
    its start. Kept spans stand at their start, mentions at their end, and one running maximum decides, so a section of n
    spans costs one sort and one pass. Kept spans of one start count by their furthest end. Null sections never overlap.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in mentions.columns])
    furthest = kept.where(F.col(section).isNotNull() & F.col("start").isNotNull()).groupBy(F.col(section).alias("sec"), F.col("start").alias("at")).agg(F.max("end").alias("b"))
    both = mentions.select(F.col(section).alias("sec"), F.col("end").alias("at"), F.col("start").alias("a"), rest.alias("row")).unionByName(furthest, allowMissingColumns=True)
    # at one position the mention that ends there comes before the span that begins there: half-open spans that touch
    w = Window.partitionBy("sec").orderBy("at", F.col("row").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    swept = both.select("row", "a", F.max("b").over(w).alias("reach")).where("row is not null")
    return swept.where(~F.coalesce(F.col("reach") > F.col("a"), F.lit(False))).select("row.*")


def merge_sources(gazetteer: DataFrame, models: DataFrame) -> DataFrame:
    """All gazetteer mentions, and the model mentions that overlap none of them."""
    return gazetteer.unionByName(without_overlaps(models, gazetteer), allowMissingColumns=True)


def islands(rows: DataFrame, keys: list[str], order: list[Column], joins: Column) -> DataFrame:
    """``rows`` with ``island``: a number that grows by one, in ``order`` within ``keys``, where ``joins`` isn't true.

    ``joins`` may use lag columns over the same window; ``window(keys, order)`` gives it.
    """
    w = window(keys, order)
    flagged = rows.withColumn("_new", F.when(joins, 0).otherwise(1))
    return flagged.withColumn("island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def window(keys: list[str], order: list[Column]):
    return Window.partitionBy(*keys).orderBy(*order)


def merge_adjacent(mentions: DataFrame, max_gap: int = 1, ties: tuple[str, ...] = ()) -> DataFrame:
    """Neighbours (by start) of one type and model whose gap is 0..max_gap become one mention.

    Texts are joined by a space; the score and other columns are the first one's; overlaps stay apart. ``ties`` orders
    mentions with the same start.
    """
    order = [F.col("start"), F.col("end"), *(F.col(t) for t in ties)]
    w = window(["section_id"], order)
    gap = F.col("start") - F.lag("end").over(w)
    same = (F.lower("entity") == F.lag(F.lower("entity")).over(w)) & (F.col("model") == F.lag("model").over(w))
    marked = islands(mentions, ["section_id"], order, same & gap.between(0, max_gap))
    first = lambda c: F.min_by(c, F.struct("start", "end", *ties)).alias(c)
    rest = [first(c) for c in mentions.columns if c not in ("section_id", "start", "end", "text")]
    parts = F.array_sort(F.collect_list(F.struct("start", "end", *ties, "text")))
    return marked.groupBy("section_id", "island").agg(F.min("start").alias("start"), F.max_by("end", F.struct("start", "end", *ties)).alias("end"), F.array_join(F.transform(parts, lambda x: x["text"]), " ").alias("text"), *rest).drop("island").select(*mentions.columns)


def first_of_span(mentions: DataFrame, order: list[str]) -> DataFrame:
    """One mention per (section, type, start, end), the first by ``order``: overlapping chunks find spans twice."""
    w = Window.partitionBy("section_id", "entity", "start", "end").orderBy(*order)
    return mentions.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_places(mentions: DataFrame, max_gap: int = 1) -> DataFrame:
    """Geographic mentions up to ``max_gap`` apart, overlaps included, become one; scores fold as (a + b) / 2."""
    order = [F.col("start"), F.col("end")]
    w = window(["section_id"], order)
    marked = islands(mentions, ["section_id"], order, (F.col("start") - F.lag("end").over(w)) <= max_gap)
    parts = F.array_sort(F.collect_list(F.struct("start", "end", "score", "text")))
    made = marked.groupBy("section_id", "island").agg(parts.alias("p"), F.min("start").alias("start"), F.max_by("end", F.struct("start", "end")).alias("end"))
    score = F.aggregate(F.slice("p", 2, F.size("p")), F.element_at("p", 1)["score"], lambda acc, x: (acc + x["score"]) / 2)
    return made.select("section_id", "start", "end", F.array_join(F.transform("p", lambda x: x["text"]), " ").alias("text"), score.alias("score"))


def replace_gazetteer(old: DataFrame, new: DataFrame) -> DataFrame:
    """Mentions of ``old`` that no gazetteer made, and those of ``new`` in sections that ``old`` has."""
    sections = old.select("section_id").distinct()
    return old.where(~F.coalesce(F.col("model"), F.lit("")).contains("Gazetteer")).unionByName(new.join(sections, "section_id", "left_semi"))


def match_mentions(samples: DataFrame, mentions: DataFrame, slack: int = 1) -> DataFrame:
    """Each sample's mention: same span and text (tier 1), else both ends within ``slack`` and the same text (tier 2).

    Where samples have a ``model``, tier 1 also wants one model's name to hold the other's, case aside (a null or empty
    one holds for all). The first mention by (start, end, text) wins within a tier; samples without one have nulls, and
    samples of one id share the best of all.

    Equal spans of one text are matched once: of mentions the first text and score of each, of samples what they ask for.
    The band is an equi-join of these on start, once per shift, so that neither copies nor a section make pairs of rows.
    """
    named = "model" in samples.columns and "model" in mentions.columns
    model = F.coalesce(F.lower("model"), F.lit("")) if named else F.lit("")
    keys = ["_section", "_start", "_end", "_low", "_model"]
    keyed = lambda frame: frame.select("*", *[c.alias(k) for c, k in zip((F.col("section_id"), F.col("start"), F.col("end"), F.lower("text"), model), keys)])
    each = keyed(mentions).groupBy(F.col("_section"), F.col("_start").alias("m_start"), F.col("_end").alias("m_end"), F.col("_low"), F.col("_model").alias("m_model")).agg(F.min(F.struct(F.col("text").alias("m_text"), F.col("score").alias("m_score"))).alias("m"))
    ours = keyed(samples)
    shifts = F.array(*[F.lit(k) for k in range(-slack, slack + 1)])
    asked = ours.select(*keys).distinct().withColumn("_shift", F.explode(shifts)).withColumn("m_start", F.col("_start") + F.col("_shift"))
    hit = asked.join(each, ["_section", "m_start", "_low"]).where(F.abs(F.col("_end") - F.col("m_end")) <= slack)
    same = (F.col("m_start") == F.col("_start")) & (F.col("m_end") == F.col("_end")) & (F.col("_model").contains(F.col("m_model")) | F.col("m_model").contains(F.col("_model")))
    best = hit.groupBy(*keys).agg(F.min(F.struct(F.when(same, 1).otherwise(2).alias("tier"), "m_start", "m_end", "m.m_text", "m.m_score")).alias("_own"))
    shared = F.when(F.col("sample_id").isNotNull(), F.min("_own").over(Window.partitionBy("sample_id"))).alias("_b")
    return ours.join(best, keys, "left").select(*samples.columns, shared).select(*samples.columns, "_b.tier", "_b.m_start", "_b.m_end", "_b.m_score")


def relabelled(mentions: DataFrame, types: DataFrame, model: str, kind: Column) -> DataFrame:
    """Mentions whose model has "Gazetteer" in its name, with another ``model`` and the type that ``kind`` makes of the
    entry's type (``entry_type``, from (id, type) by linked_id); others stay as they are."""
    table = types.groupBy(F.col("id").alias("linked_id")).agg(F.max("type").alias("entry_type"))
    ours = F.coalesce(F.col("model"), F.lit("")).contains("Gazetteer")
    joined = mentions.join(table, "linked_id", "left")
    changed = {"entity": F.when(ours, kind).otherwise(F.col("entity")), "model": F.when(ours, model).otherwise(F.col("model"))}
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in mentions.columns])
