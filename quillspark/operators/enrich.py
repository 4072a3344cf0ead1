"""Vocabulary enrichment with ids and aliases: a client's or a provider's answers, kept in tables.

Defined results: null and empty ids count as lacking; repeated answers count once, the least where they differ; ids
without an answer stay empty; an empty vocabulary gives an empty one; other columns are kept.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.text import qid, strip
from quillspark.operators.link import dot, nearest


def find_ids(vocab: DataFrame, *answers: DataFrame) -> DataFrame:
    """``vocab`` with wikidata_id: its own, else the first provider's (id, qid) in order."""
    joined = reduce(lambda f, ka: f.join(ka[1].groupBy("id").agg(F.min("qid").alias(f"_q{ka[0]}")), "id", "left"), enumerate(answers), vocab)
    found = F.coalesce(F.when(qid(F.col("wikidata_id")) != "", F.col("wikidata_id")), *[F.col(f"_q{k}") for k in range(len(answers))], F.lit(""))
    return joined.withColumn("wikidata_id", found).select(*vocab.columns)


def add_aliases(vocab: DataFrame, entities: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Fills wikidata_aliases from (qid, label, aliases): the label first, then aliases, without the concept, excluded
    words and terms the vocabulary has already. Rows that have aliases stay."""
    terms = vocab.select(F.lower(strip(F.col("concept"))).alias("_t")).distinct()
    wanted = vocab.where(F.coalesce("wikidata_aliases", F.lit("")) == "").select("id", F.lower(strip(F.col("concept"))).alias("_c"), qid(F.col("wikidata_id")).alias("qid"))
    each = wanted.join(entities, "qid").select("id", "_c", F.posexplode(F.concat(F.array("label"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("k", "alias")).withColumn("_t", F.lower(strip(F.col("alias"))))
    new = each.where((F.col("_t") != F.col("_c")) & ~F.col("_t").isin(*exclude)).join(terms, "_t", "left_anti")
    first = new.groupBy("id", "_t").agg(F.min(F.struct("k", "alias")).alias("a"))
    lists = first.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("a")), lambda x: x["alias"]), " | ").alias("_a"))
    return vocab.join(lists, "id", "left").withColumn("wikidata_aliases", F.coalesce("_a", "wikidata_aliases", F.lit(""))).select(*vocab.columns)


class Client(Protocol):
    """What a network service of entities answers; errors give empty answers."""

    def search(self, term: str) -> list[dict]:
        """Candidates (qid, label, description) of a term."""

    def aliases(self, qids: list[str]) -> dict[str, list[str]]:
        """By id, its label and then its aliases."""

    def redirect(self, qid: str) -> str | None: ...


class TableClient:
    """A client that answers from tables in memory: a stand-in for a network service."""

    def __init__(self, entities: list[dict], redirects: dict[str, str] | None = None) -> None:
        self.entities, self.redirects = entities, redirects or {}

    def search(self, term: str) -> list[dict]:
        return [e for e in self.entities if term.lower() in (x.lower() for x in (e["label"], *e.get("aliases", ())))]

    def aliases(self, qids: list[str]) -> dict[str, list[str]]:
        by = {e["qid"]: [e["label"], *e.get("aliases", ())] for e in self.entities}
        return {q: by.get(q, []) for q in qids}

    def redirect(self, qid: str) -> str | None:
        return self.redirects.get(qid)


def found_candidates(terms: DataFrame, client: Client) -> DataFrame:
    """(id, qid, label, rank) of every (id, concept): what the client finds; a term that makes it raise has none."""
    shared = terms.sparkSession.sparkContext.broadcast(client)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = []
            for ident, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    answers = shared.value.search(term) if term else []
                except Exception:  # noqa: BLE001 - a service's failure is an empty answer
                    answers = []
                rows += [(ident, a["qid"], a["label"], k) for k, a in enumerate(answers, 1)]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int32()))], names=["id", "qid", "label", "rank"])

    return terms.select(F.col("id").cast("string").alias("id"), "concept").mapInArrow(run, "id string, qid string, label string, rank int")


def most_similar(entries: DataFrame, found: DataFrame, threshold: float, digits: int = 6) -> DataFrame:
    """(id, qid, score): by entry (id, vector) the candidate (id, qid, vector) of the highest cosine, if it reaches ``threshold``.

    Scores are rounded; ties go to the lower qid; vectors of length 0 have cosine 0.
    """
    cosine = dot("a", "b") / F.greatest(F.sqrt(dot("a", "a")) * F.sqrt(dot("b", "b")), F.lit(1e-12))
    scored = entries.select("id", F.col("vector").alias("a")).join(found.select("id", "qid", F.col("vector").alias("b")), "id").select("id", "qid", F.round(cosine, digits).alias("score"))
    best = scored.groupBy("id").agg(F.min(F.struct((-F.col("score")).alias("s"), "qid")).alias("m"))
    return best.select("id", F.col("m.qid").alias("qid"), (-F.col("m.s")).alias("score")).where(F.col("score") >= threshold)


def most_similar_within(queries: DataFrame, entries: DataFrame, group: str, threshold: float, digits: int = 6) -> DataFrame:
    """``most_similar`` where the candidates of a query (id, vector, ``group``) are all other entries (qid, vector, ``group``)
    of its group: found block by block, so no pair is made a row."""
    best = nearest(queries.withColumnRenamed("id", "query"), entries.withColumnRenamed("qid", "entry"), 1, digits, within=group, cosine=True, others=True)
    return best.where(F.col("score") >= threshold).select(F.col("query").alias("id"), F.col("entry").alias("qid"), "score")


def first_title(titles: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, qid): by entry the first of a title model's answers (id, rank, title) that has an id in (title, qid)."""
    known = ids.where("qid <> ''").groupBy("title").agg(F.min("qid").alias("qid"))
    return titles.join(known, "title").groupBy("id").agg(F.min_by("qid", F.struct("rank", "qid")).alias("qid"))


def aliases_of(ids: DataFrame, answers: DataFrame) -> DataFrame:
    """(qid, label, aliases) of every asked id (qid): the label of the answers' (qid, label, alias), their distinct aliases in
    order; ids without an answer have an empty label and no aliases."""
    made = answers.groupBy("qid").agg(F.min("label").alias("label"), F.array_sort(F.collect_set("alias")).alias("aliases"))
    return ids.select("qid").distinct().join(made, "qid", "left").select("qid", F.coalesce("label", F.lit("")).alias("label"), F.coalesce("aliases", F.array().cast("array<string>")).alias("aliases"))


def enrich(vocab: DataFrame, entities: DataFrame, *answers: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """``vocab`` with ids and aliases where they lack; rows that have both go through untouched."""
    have = (F.coalesce("wikidata_id", F.lit("")) != "") & (F.coalesce("wikidata_aliases", F.lit("")) != "")
    named = find_ids(vocab.where(~have), *answers)
    # terms of the whole vocabulary are no aliases, so the rows that are full take part
    both = add_aliases(named.unionByName(vocab.where(have)), entities, exclude)
    return both.select(*vocab.columns)


class AffiliationProvider(Protocol):
    def resolve(self, raw: list[str]) -> list[dict]:
        """By affiliation, anything that JSON can hold."""


def resolved_affiliations(affiliations: DataFrame, provider: AffiliationProvider, batch_rows: int = 32) -> DataFrame:
    """(affiliation_id, raw_affiliation, result as JSON); the rows of a batch that makes the provider raise are left out."""
    shared = affiliations.sparkSession.sparkContext.broadcast(provider)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in source:
            for at in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(at, batch_rows)
                try:
                    said = [json.dumps(x, default=str, ensure_ascii=False, sort_keys=True) for x in shared.value.resolve(batch.column(1).to_pylist())]
                except Exception:  # noqa: BLE001 - a failed batch is skipped, as it would be by hand
                    continue
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(said, pa.string())], names=["affiliation_id", "raw_affiliation", "result"])

    return affiliations.select("affiliation_id", "raw_affiliation").mapInArrow(run, "affiliation_id string, raw_affiliation string, result string")
