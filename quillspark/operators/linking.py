"""The linking run over recognised mentions: filters, linking by type with fallbacks, reranking, statistics.

Models are providers: an ``Embedder`` gives vectors of texts, a ``Reranker`` picks one of numbered candidates. Those given
here are deterministic stand-ins.

Mentions are rows (section_id, start, end, text, entity, ...); sections are (section_id, text), of which the last by
``ord`` counts, or the greatest text where there is no such column. Defined results: mentions without a section, or
whose section has a null or empty text, pass through unfiltered and unlinked; null texts and types link to nothing;
repeated mentions are linked each; an empty table gives an empty table; columns named like a result are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import strip
from quillspark.operators import link
from quillspark.operators.filters import MentionFilter
from quillspark.plans.shared import written

LINKED = ("linked_id", "linked_name", "source", "score")


class Embedder(Protocol):
    def vectors(self, texts: list[str]) -> np.ndarray:
        """[texts, dimensions] of floats, each row of length 1."""


class HashEmbedder:
    """Vectors of hashed character trigrams: a stand-in whose dot product grows with what two texts share."""

    def __init__(self, dimensions: int = 64) -> None:
        self.dimensions = dimensions

    def vectors(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions))
        for i, text in enumerate(texts):
            low = f"  {(text or '').lower()} "
            for k in range(len(low) - 2):
                out[i, zlib.crc32(low[k : k + 3].encode()) % self.dimensions] += 1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


class Reranker(Protocol):
    def answers(self, prompts: list[str], scores: list[list[float]]) -> list[str]:
        """By prompt, a number of a candidate or REJECT."""


class FirstCandidate:
    """Picks the first candidate where its score reaches ``least``, else rejects: a stand-in."""

    def __init__(self, least: float = 0.5) -> None:
        self.least = least

    def answers(self, prompts: list[str], scores: list[list[float]]) -> list[str]:
        return ["1" if s and s[0] >= self.least else "REJECT" for s in scores]


def embedded(frame: DataFrame, text: str, embedder: Embedder, keys: tuple[str, ...]) -> DataFrame:
    """``keys`` and the ``vector`` of a text column."""
    shared = frame.sparkSession.sparkContext.broadcast(embedder)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            made = shared.value.vectors(batch.column(len(keys)).to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keys))), pa.array(list(made), pa.list_(pa.float64()))], names=[*keys, "vector"])

    kinds = ", ".join(f"`{k}` {frame.schema[k].dataType.simpleString()}" for k in keys)
    return frame.select(*keys, F.coalesce(text, F.lit("")).alias("_text")).mapInArrow(run, f"{kinds}, vector array<double>")


def section_texts(sections: DataFrame) -> DataFrame:
    order = "ord" if "ord" in sections.columns else "text"
    return sections.groupBy("section_id").agg(F.max_by("text", order).alias("section_text"))


def with_text(mentions: DataFrame, sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``mentions`` with section_text, and those whose section has none, which pass through as they are."""
    joined = mentions.drop("section_text").join(section_texts(sections), "section_id", "left")
    has = F.coalesce(F.col("section_text") != "", F.lit(False))
    return joined.where(has), joined.where(~has).drop("section_text")


def _free(mentions: DataFrame, names: tuple[str, ...] = LINKED) -> DataFrame:
    return mentions.drop(*[n for n in names if n in mentions.columns])


def _nothing() -> list[Column]:
    return [F.lit(None).cast(t).alias(n) for n, t in zip(LINKED, ("string", "string", "string", "double"))]


def link_by_type(mentions: DataFrame, sections: DataFrame, vocabularies: dict[str, DataFrame], linkers: dict, rules: MentionFilter | None = None, embedder: Embedder | None = None, threshold: float = 0.8, context_chars: int = 500) -> DataFrame:
    """``mentions`` with linked_id, linked_name, source and score, by the linker of their type.

    Mentions that have a linked_id already keep it; types without a linker pass through. A (type, lower-cased text) is
    looked up once; what stays without an entry goes to the semantic fallback, where its linker has one, with the first
    ``context_chars`` characters of the section of its first use. Filtered mentions go.
    """
    texts, through = with_text(mentions, sections)
    if rules is not None:
        texts = rules.apply(texts)
    done = F.col("linked_id").isNotNull() if "linked_id" in mentions.columns else F.lit(False)
    kept = [c for c in mentions.columns if c not in LINKED]
    before = [F.col(n) if n in mentions.columns else c for n, c in zip(LINKED, _nothing())]
    low = F.lower("entity")
    known = low.isin(*[k.lower() for k in linkers])
    asked = written(texts.where(~done & F.coalesce(known, F.lit(False))))
    rest = texts.where(done | ~F.coalesce(known, F.lit(False))).select(*kept, *before)
    made = [rest, through.select(*kept, *before)]
    first = link.first_uses(asked.select("text", "entity", "section_id", "start", F.substring("section_text", 1, context_chars).alias("context")), ["section_id", "start"], F.concat_ws(":", low, F.lower("text")))
    for kind, linker in linkers.items():
        memo = first.where((F.lower("entity") == kind.lower()) & (strip(F.col("text")) != "")).select("key", "text", "entity", "context")
        found = link.exact(memo, vocabularies[linker.vocabulary]).select("key", "context", "linked_id", "linked_name", F.lit(None).cast("double").alias("score"))
        if linker.fallback == "semantic" and embedder is not None:
            missing = written(found.where("linked_id is null").select(F.col("key").alias("query"), "context"))
            names = vocabularies[linker.vocabulary].groupBy("id").agg(F.min_by("concept", "ord").alias("concept"))
            top = link.top_k(embedded(missing, "context", embedder, ("query",)), embedded(names, "concept", embedder, ("id",)).withColumnRenamed("id", "entry"), 1)
            near = link.best_above(top, threshold).join(names, F.col("entry") == F.col("id"))
            found = found.where("linked_id is not null").select("key", "linked_id", "linked_name", "score").unionByName(near.select(F.col("query").alias("key"), F.col("entry").alias("linked_id"), F.col("concept").alias("linked_name"), "score"))
        table = found.where("linked_id is not null").select("key", "linked_id", "linked_name", F.lit(linker.source).alias("source"), "score")
        mine = _free(asked).where(low == kind.lower()).withColumn("_key", F.when(F.col("text").isNotNull(), F.concat_ws(":", low, F.lower("text"))))
        made.append(mine.join(table, F.col("_key") == F.col("key"), "left").select(*kept, *LINKED))
    out = made[0]
    for frame in made[1:]:
        out = out.unionByName(frame)
    return out


def semantic_links(mentions: DataFrame, entries: DataFrame, embedder: Embedder, threshold: float = 0.8, window: int = 5, most: int = 5, instruct: str | None = None) -> DataFrame:
    """(text, linked_id, linked_name, score) of the distinct mention texts (text, section): their best entry by vectors.

    The query is the mean of the vectors of the mention's contexts (of the mention where it has none), or, with
    ``instruct``, one vector of the instruction and the mention with its contexts as examples.
    """
    asked = link.contexts(mentions.select("text", "section").groupBy(F.lower("text").alias("text")).agg(F.min("section").alias("section")), window, most)
    if instruct is not None:
        queries = embedded(asked.select(F.col("text").alias("query"), instruct_query(instruct, F.col("text"), F.col("contexts")).alias("q")), "q", embedder, ("query",))
    else:
        each = asked.select(F.col("text").alias("query"), F.posexplode(F.when(F.size("contexts") > 0, F.col("contexts")).otherwise(F.array("text"))).alias("k", "q"))
        made = embedded(each, "q", embedder, ("query", "k")).select("query", F.posexplode("vector").alias("d", "x"))
        mean = made.groupBy("query", "d").agg(F.avg("x").alias("x")).groupBy("query").agg(F.array_sort(F.collect_list(F.struct("d", "x"))).alias("v"))
        queries = mean.select("query", F.transform("v", lambda s: s["x"]).alias("vector"))
    vectors = embedded(entries.select(F.col("id").alias("entry"), "concept"), "concept", embedder, ("entry",))
    best = link.best_above(link.top_k(queries, vectors, 1), threshold)
    return best.join(entries.select(F.col("id").alias("entry"), "concept"), "entry").select(F.col("query").alias("text"), F.col("entry").alias("linked_id"), F.col("concept").alias("linked_name"), "score")


def instruct_query(task: str, mention: Column, contexts: Column) -> Column:
    """An instruct model's query: the task, the mention, and its contexts as a list where there are any."""
    listed = F.concat(F.lit("\nExample occurrences:\n- "), F.array_join(contexts, "\n- "))
    return F.concat(F.lit(f"Instruct: {task}\nQuery: "), mention, F.when(F.size(contexts) > 0, listed).otherwise(F.lit("")))


def ask(prompts: DataFrame, reranker: Reranker) -> DataFrame:
    """(query, answer) of (query, prompt, scores)."""
    shared = prompts.sparkSession.sparkContext.broadcast(reranker)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            said = shared.value.answers(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string())], names=["query", "answer"])

    return prompts.select("query", "prompt", "scores").mapInArrow(run, f"query {prompts.schema['query'].dataType.simpleString()}, answer string")


def rerank_sections(mentions: DataFrame, sections: DataFrame, candidates: DataFrame, names: DataFrame, reranker: Reranker, threshold: float = 0.5) -> DataFrame:
    """Mentions with linked_id, linked_name and score by a reranker's choice among ``candidates`` (query, entry, score, rank).

    ``query`` is the lower-cased mention text, ``names`` (entry, name). A mention that its section doesn't hold, case
    aside, goes; so the answer of a text is asked once, at its first use. Only the first candidate is held against the
    threshold.
    """
    texts, through = with_text(mentions, sections)
    there = texts.where(F.lower("section_text").contains(F.lower("text")))
    kept = [c for c in mentions.columns if c not in ("linked_id", "linked_name", "score")]
    first = link.first_uses(there.select("text", "section_id", "start", "section_text"), ["section_id", "start"])
    wide = candidates.join(names, "entry")
    listed = wide.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "name", "score"))).alias("c"))
    prompts = first.join(listed, F.col("key") == F.col("query")).select("query", link.prompt(F.col("text"), F.col("section_text"), F.transform("c", lambda x: x["name"])).alias("prompt"), F.transform("c", lambda x: x["score"]).alias("scores"))
    chosen = link.choose(candidates, ask(prompts, reranker), threshold).join(names, "entry").select("query", F.col("entry").alias("linked_id"), F.col("name").alias("linked_name"), "score")
    linked = _free(there.withColumn("_key", F.lower("text")), ("linked_id", "linked_name", "score")).join(chosen, F.col("_key") == F.col("query"), "left")
    none = [F.lit(None).cast(chosen.schema[n].dataType).alias(n) for n in ("linked_id", "linked_name", "score")]
    return linked.select(*kept, "linked_id", "linked_name", "score").unionByName(through.select(*kept, *none))


def statistics(before: DataFrame, after: DataFrame, rules: MentionFilter, by: str) -> DataFrame:
    """By file (or another column): total, too_short, blocked, linked and the rate of linked among the kept."""
    counts = rules.stats(before, [by])
    mismatch = F.count_if(F.col("type_mismatch")) if "type_mismatch" in after.columns else F.lit(0).cast("long")
    linked = after.groupBy(by).agg(F.count("linked_id").alias("linked"), mismatch.alias("mismatched"), F.countDistinct(F.lower(strip(F.col("text")))).alias("cached"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("linked", "mismatched", "cached")]
    return counts.join(linked, by, "left").select(by, "total", "kept", "too_short", "blocked", *zero).withColumn("rate", F.when(F.col("kept") > 0, F.round(F.col("linked") / F.col("kept"), 6)).otherwise(0.0))
