"""Place mentions: keep rules, context sentences, offline geocoding, and the chain of these.

Recognisers of places and of their roles are providers. Defined results: mentions without a context sentence, a usable
name or an entry go; sections without places keep an empty list where the step says so; null texts have no places;
repeated mentions are one; ties fall to the text; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions.text import without_direction
from quillspark.operators.filters import COUNTRY_CODES, ROLES, valid_place
from quillspark.operators.recognise import Provider, predict
from quillspark.operators.spans import islands, window


def sentences(text: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(text, r"([.!?])\s+", "$1\u0001"), "\u0001"), lambda s: F.trim(s) != "")


def context_sentence(text: Column, mention: Column) -> Column:
    """The first sentence that holds the mention's text, case kept; null if none does."""
    return F.try_element_at(F.filter(sentences(text), lambda s: s.contains(mention)), F.lit(1))


def normalised(mentions: DataFrame, demonyms: DataFrame) -> DataFrame:
    """``mentions`` with normalized_text: no leading direction, demonyms (form, country) replaced."""
    made = mentions.withColumn("_n", without_direction(F.col("text")))
    table = demonyms.groupBy(F.col("form").alias("_n")).agg(F.max("country").alias("_c"))
    return made.join(table, "_n", "left").withColumn("normalized_text", F.coalesce("_c", "_n")).drop("_c", "_n")


def kept(mentions: DataFrame, codes: tuple[str, ...] = COUNTRY_CODES) -> DataFrame:
    """The first mention (line, start) of each place by file, in a role of interest, with a usable name."""
    rows = mentions.where(F.col("role").isin(*ROLES) & (F.col("normalized_text") != "") & ((F.length("normalized_text") > 2) | F.upper("normalized_text").isin(*codes)))
    w = Window.partitionBy("source_file", F.lower("normalized_text")).orderBy("line", "start")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def geocoded(mentions: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """``mentions`` with osm of an offline table (name, osm); each distinct name is looked up once, misses go."""
    names = mentions.select(F.lower("normalized_text").alias("_k")).distinct()
    table = gazetteer.groupBy(F.lower("name").alias("_k")).agg(F.max_by("osm", F.col("osm.importance")).alias("osm"))
    return mentions.withColumn("_k", F.lower("normalized_text")).join(names.join(table, "_k"), "_k").drop("_k")


def geotagged(sections: DataFrame, recogniser: Provider, roles: RoleProvider, size: int = 512, overlap: int = 50) -> DataFrame:
    """(section_id, entities) of every section: places with their role in their context sentence, and the role's score.

    Chunks overlap, so a span found twice is taken once, the first by start. A place that no sentence holds goes.
    """
    found = predict(sections, recogniser, size=size, overlap=overlap)
    once = found.groupBy("section_id", "entity", "start", "end").agg(F.min_by(F.struct("text", "score"), F.struct("score", "text")).alias("m")).select("section_id", "entity", "start", "end", "m.text")
    body = sections.groupBy("section_id").agg(F.max("text").alias("_body"))
    placed = once.join(body, "section_id").withColumn("context", context_sentence(F.col("_body"), F.col("text"))).where("context is not null").drop("_body")
    shared = sections.sparkSession.sparkContext.broadcast(roles)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            said = shared.value.roles(batch.column(batch.schema.get_field_index("text")).to_pylist(), batch.column(batch.schema.get_field_index("context")).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([r for r, _ in said], pa.string()), pa.array([x for _, x in said], pa.float64())], names=[*batch.schema.names, "role", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema)
    made = placed.mapInArrow(run, f"{kinds}, role string, score double")
    lists = made.groupBy("section_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "entity", "text", "role", "score"))).alias("entities"))
    empty = F.array().cast(lists.schema["entities"].dataType)
    return body.select("section_id").join(lists, "section_id", "left").withColumn("entities", F.coalesce("entities", empty))


class RoleProvider(Protocol):
    def roles(self, mentions: list[str], contexts: list[str]) -> list[tuple[str, float]]:
        """By mention, its role in its context, and how sure."""


class KeywordRoles:
    """The role whose keyword is in the context first, else ``other``: a stand-in."""

    def __init__(self, keywords: dict[str, str], other: str = "Other") -> None:
        self.keywords, self.other = {k.lower(): v for k, v in keywords.items()}, other

    def roles(self, mentions: list[str], contexts: list[str]) -> list[tuple[str, float]]:
        out = []
        for context in contexts:
            hits = sorted((at, role) for k, role in self.keywords.items() if (at := context.lower().find(k)) >= 0)
            out.append((hits[0][1], 0.9) if hits else (self.other, 0.5))
        return out


def linked_places(tagged: DataFrame, demonyms: DataFrame, gazetteer: DataFrame, max_gap: int = 1) -> DataFrame:
    """(source_file, section_id, entities) of sections with linked places: ``tagged`` is (source_file, line, section_id, entities).

    Places up to ``max_gap`` apart are merged (scores fold as (a + b) / 2, the role is the first one's), kept by role and
    name, each once a file, and looked up in ``gazetteer`` (name, osm); those without a valid entry go.
    """
    flat = tagged.select("source_file", "line", "section_id", F.inline("entities"))
    where = ["source_file", "line", "section_id"]
    w = window(where, [F.col("start"), F.col("end"), F.col("text")])
    merged = islands(flat, where, [F.col("start"), F.col("end"), F.col("text")], (F.col("start") - F.lag("end").over(w)) <= max_gap)
    parts = F.array_sort(F.collect_list(F.struct("start", "end", "text", "role", "score"))).alias("p")
    folded = F.aggregate(F.slice("p", 2, F.size("p")), F.element_at("p", 1)["score"], lambda acc, x: (acc + x["score"]) / 2)
    rows = merged.groupBy(*where, "island").agg(parts).select(*where, F.element_at("p", 1)["start"].alias("start"), F.element_at("p", -1)["end"].alias("end"), F.array_join(F.transform("p", lambda x: x["text"]), " ").alias("text"), F.element_at("p", 1)["role"].alias("role"), folded.alias("score"))
    found = geocoded(kept(normalised(rows, demonyms)), gazetteer).where(valid_place("osm"))
    return found.groupBy("source_file", "section_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "text", "normalized_text", "role", "score", "osm"))).alias("entities"))


def marked_context(context: Column, mention: Column) -> Column:
    """A context with the first use of the mention between START and END marks."""
    at = F.position(mention, context)
    return F.when(at > 0, F.concat(F.substring(context, F.lit(1), at - 1), F.lit("[START] "), mention, F.lit(" [END]"), F.substring(context, at + F.length(mention), F.length(context)))).otherwise(context)
