"""A corpus pipeline of five stages over ``documents``; each works on all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Null and empty texts, null columns, repeated rows, empty tables and extra columns have the results that the operators'
modules state; extra columns are dropped by the first stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm import linechunks, mixing, packing, simhash, toxicity
from quillspark.llm.common import shared_folder, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the deobfuscated-text model rejects go."""
    docs = docs.select(COLUMNS)
    return toxicity.accepted(docs, toxicity.fit_tables(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines stay in one document only; no document goes."""
    return linechunks.dedup(docs.select(COLUMNS)).select(COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five words, a similarity of 0.8)."""
    return simhash.one_of_each(docs.select(COLUMNS))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come in their target shares: a row per whole pass, and one of the words of the drawn blocks."""
    return mixing.mixed_documents(docs.select(COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", toxicity_filter), ("line dedup", line_dedup), ("simhash near-dedup", simhash_near_dedup), ("mixing", source_mix), ("packing", best_fit_packing)]

#: Trained models, seeded draws and iterations: not to be said in SQL. tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet to the shared folder and read again."""
    shared = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(path := f"{shared}/pipeline-{uuid.uuid4().hex}/{k}")
            docs = spark.read.parquet(path)
    return docs
