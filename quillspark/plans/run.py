"""Runs: step selection, pending sections against a manifest, and sinks whose reruns add nothing twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

MANIFEST = "key string, step string, status string, run long"
STEPS = ("gaz", "ner", "el", "geotagging", "affiliations", "all")


def pending(sections: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Rows of ``sections`` that the manifest doesn't know yet."""
    return sections.join(manifest.select(key), key, "left_anti")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(MANIFEST).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)


def run_step(step: str, sections: DataFrame, make: Callable[[DataFrame], DataFrame], out: str, manifest: str, resume: bool = True) -> DataFrame:
    """Writes ``make`` of the pending ``sections`` (section_id, ...) to ``out`` and enters them in the manifest.

    Each run writes a folder of its own (``run=<id>``) before the manifest names it, so what a failed run left is never
    read, and rows that are equal stay as they are. Sections without results are entered as ``no_entities``. Sections with
    a null id are made in every run; a second run without ``resume`` replaces the results of the sections it made.
    """
    if step not in STEPS:
        raise ValueError(f"unknown step {step!r}")
    spark = sections.sparkSession
    todo = sections
    if resume:
        done = read_manifest(spark, manifest).where(F.col("step") == step).select(F.col("key").alias("section_id"))
        todo = pending(sections, done, "section_id")
    number = read_manifest(spark, manifest).agg(F.coalesce(F.max("run"), F.lit(-1))).first()[0] + 1
    folder = f"{out}/run={number}"
    make(todo).write.mode("overwrite").parquet(folder)
    has = spark.read.parquet(folder).select("section_id").distinct().withColumn("_has", F.lit(True))
    entry = todo.select("section_id").distinct().join(has, "section_id", "left").select(F.col("section_id").cast("string").alias("key"), F.lit(step).alias("step"), F.when(F.col("_has"), "done").otherwise("no_entities").alias("status"), F.lit(number).cast("long").alias("run"))
    entry.write.mode("append").parquet(manifest)
    return results(spark, out, manifest, step)


def results(spark: SparkSession, out: str, manifest: str, step: str) -> DataFrame:
    """Rows of ``out`` that the manifest names, of the last run that made their section."""
    last = read_manifest(spark, manifest).where(F.col("step") == step).groupBy(F.col("key").alias("_key")).agg(F.max("run").alias("_run"))
    rows = spark.read.option("basePath", out).parquet(out)
    named = rows.join(last, rows["section_id"].cast("string").eqNullSafe(last["_key"]) & (rows["run"] == last["_run"]))
    return named.select([c for c in rows.columns if c != "run"])
