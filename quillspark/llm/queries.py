"""The registered queries of the operators: production parameters, whole tables, full results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm import imatch, jpeg, langid, linechunks, mixing, packing, quality, sharding, simhash, toxicity
from quillspark.llm.common import table


def op1_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit_tables(docs, table(spark, sf_dir, "labels")))


def op2_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.store(table(spark, sf_dir, "documents")).drop("media")


def op3_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.component_ids(table(spark, sf_dir, "documents"))


def op4_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op5_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return imatch.compare(docs, imatch.fit_lexicon(docs))


def op6_naive_bayes_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit_table(docs))


def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit_tables(docs, table(spark, sf_dir, "labels")))


def op10_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linechunks.dedup(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"))


QUERIES = {f.__name__: f for f in (op1_compression_quality, op2_jpeg_media, op3_simhash_pivots, op4_label_propagation_shards, op5_imatch_fingerprints, op6_naive_bayes_language, op7_sum_of_squares_packing, op8_sainte_lague_mix, op9_noisy_channel_toxicity, op10_line_chunk_dedup)}

#: None of the ten can be said in SQL (trained models, XXH64, Huffman codes, seeded draws, iterations): tests/llm holds
#: each against brute force, a round trip or held-out accuracy.
ORACLE_SQL: dict[str, str] = {}
