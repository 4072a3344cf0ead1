"""Pairs of section and mention files, expanded-section caches, papers, and small JSON files on the driver.

Defined results: names without a partner are left out; a missing or broken JSON file is the default; rows of a broken
cache line are left out; an empty folder gives an empty table.
"""

from __future__ import annotations

import json
import logging
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SECTIONS = "section_id string, section_content_expanded string, section_type string, paper_path string"


def load_json(path: str, default=None):
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return default


def save_json(path: str, value) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")


def append_json_line(path: str, value) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "a", encoding="utf-8") as out:
        out.write(json.dumps(value, ensure_ascii=False) + "\n")


def logger(name: str, path: str | None = None) -> logging.Logger:
    """A logger to the console, and to a file where one is named; its handlers are added once."""
    made = logging.getLogger(name)
    if not made.handlers:
        made.setLevel(logging.INFO)
        for handler in [logging.StreamHandler(), *([logging.FileHandler(path, encoding="utf-8")] if path else [])]:
            handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
            made.addHandler(handler)
    return made


def pairs(sections: DataFrame, mentions: DataFrame) -> DataFrame:
    """(doc_id, sections_path, mentions_path) of the files (path) of both kinds that share a name, ``_sections`` aside."""
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"(?<=.)\.[^.]*$", "")
    left = sections.select(F.regexp_replace(stem, "_sections$", "").alias("doc_id"), F.col("path").alias("sections_path"))
    right = mentions.select(stem.alias("doc_id"), F.col("path").alias("mentions_path"))
    return left.join(right, "doc_id")


def paths(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path) of the files of a folder and those below it that match a glob."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder).select("path")


def save_sections(sections: DataFrame, path: str) -> None:
    """Writes expanded sections as a cache, once: a cache that is there stays."""
    sections.select([c.split()[0] for c in SECTIONS.split(", ")]).write.mode("ignore").parquet(path)


def load_sections(spark: SparkSession, path: str) -> DataFrame:
    """Expanded sections of a cache, all columns text: Parquet, or CSV files with a backslash escape."""
    if path.endswith(".csv"):
        read = spark.read.schema(SECTIONS + ", _broken string").option("columnNameOfCorruptRecord", "_broken")
        return read.csv(path, header=True, multiLine=True, escape="\\").where("_broken is null").drop("_broken")
    return spark.read.schema(SECTIONS).parquet(path)


def of_papers(mentions: DataFrame, sections: DataFrame) -> DataFrame:
    """Mentions with the paper_path of their section; a section in several papers gives each its mentions."""
    return mentions.join(sections.select("section_id", "paper_path").distinct(), "section_id")


def merge_counts(old: DataFrame, new: DataFrame) -> DataFrame:
    """By file in both: mentions by the gazetteer (new) and by models (old rows without "Gazetteer"), and their sum."""
    models = old.groupBy("source_file").agg(F.count_if(~F.coalesce(F.col("model"), F.lit("")).contains("Gazetteer")).alias("models"))
    return models.join(new.groupBy("source_file").agg(F.count("*").alias("gazetteer")), "source_file").withColumn("total", F.col("models") + F.col("gazetteer"))
