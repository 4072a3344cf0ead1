"""Title/abstract and legal records (JSON arrays or JSON lines) as sections, and the sinks' JSON lines.

Defined results: records without an id or without text give no section; null and blank titles and texts are absent;
repeated records are repeated sections; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillspark.functions.text import squeeze, strip

TITLE_ABSTRACT = "oaireid string, titles array<string>, abstracts array<string>, pids array<struct<scheme:string,value:string>>, resulttype string"
LEGAL = "rsNr string, en_lawTitle string, en_lawText string"
LINK = "struct<source:string,id:string,name:string,score:double,frequency:bigint>"
ENTITIES = f"section_id string, entities array<struct<entity:string,text:string,score:double,start:int,end:int,model:string,domain:string,section_id:string,linking:array<{LINK}>,type_mismatch:boolean>>"


def json_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a file, or of the files of a folder: each an array (its first character tells) or lines.

    Malformed and blank lines are skipped, and so is an array that is broken.
    """
    return directory(spark, path, schema, pattern="*").drop("source_file")


def _join(title: Column, body: Column, stops: str) -> Column:
    glue = F.when(title.rlike(f"[{stops}]$"), " ").otherwise(". ")
    return F.when((title != "") & (body != ""), F.concat(title, glue, body)).when(title != "", title).when(body != "", body)


def title_abstract_sections(records: DataFrame, combine: bool = True) -> DataFrame:
    """section_id, section_content_expanded, oaireid, section_type of records with an id and some text.

    Only the first title and the first abstract count; ``combine`` makes one section of both.
    """
    title = squeeze(F.coalesce(F.try_element_at("titles", F.lit(1)), F.lit("")))
    abstract = squeeze(F.coalesce(F.try_element_at("abstracts", F.lit(1)), F.lit("")))
    rows = records.where(F.coalesce("oaireid", F.lit("")) != "").select("oaireid", title.alias("t"), abstract.alias("a"))
    if combine:
        kind = F.when((F.col("t") != "") & (F.col("a") != ""), "title_abstract").when(F.col("t") != "", "title").otherwise("abstract")
        made = rows.select(F.col("oaireid").alias("section_id"), _join(F.col("t"), F.col("a"), ".!?").alias("section_content_expanded"), "oaireid", kind.alias("section_type"))
    else:
        one = lambda c, kind: F.struct(F.concat("oaireid", F.lit(f"#{kind}")).alias("section_id"), F.col(c).alias("section_content_expanded"), F.col("oaireid"), F.lit(kind).alias("section_type"))
        made = rows.select(F.inline(F.array(one("t", "title"), one("a", "abstract")))).where("section_content_expanded <> ''")
    return made.where("section_content_expanded is not null")


def legal_sections(records: DataFrame, include_title: bool = True) -> DataFrame:
    """section_id, section_content_expanded, rsNr, section_type, title; blanks are squeezed after joining."""
    title, body = strip(F.coalesce("en_lawTitle", F.lit(""))), strip(F.coalesce("en_lawText", F.lit("")))
    rows = records.where(F.coalesce("rsNr", F.lit("")) != "").select("rsNr", title.alias("title"), body.alias("b"))
    text = _join(F.col("title"), F.col("b"), ".!?:") if include_title else F.when(F.col("b") != "", F.col("b")).otherwise(F.col("title"))
    made = rows.where("title <> '' or b <> ''").select(F.col("rsNr").alias("section_id"), squeeze(text).alias("section_content_expanded"), "rsNr", F.lit("legal_text").alias("section_type"), "title")
    return made


def directory(spark: SparkSession, path: str, schema: str, domain: str | None = None, part: str | None = None, pattern: str = "*.json*") -> DataFrame:
    """Records of all matching files below ``path`` with source_file; arrays and lines may stand side by side.

    ``domain`` keeps files whose name begins with it, ``part`` those whose name holds it, case aside. Malformed lines and
    arrays are skipped: every line of a file of lines is read by itself, a file that begins with ``[`` as one value.
    """
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path, wholetext=True).select(F.url_decode(F.regexp_replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), r"\\+", "%2B")).alias("source_file"), strip(F.col("value")).alias("value"))
    if domain:
        text = text.where(F.lower("source_file").startswith(domain.lower()))
    if part:
        text = text.where(F.lower("source_file").contains(part.lower()))
    array = F.col("value").startswith("[")
    whole = text.where(array).select("source_file", F.explode(F.from_json("value", f"array<struct<{_typed(schema)}>>")).alias("r"))
    lines = text.where(~array).select("source_file", F.explode(F.split("value", r"\n")).alias("line")).where(F.trim("line").startswith("{")).select("source_file", F.from_json("line", f"struct<{_typed(schema)}>").alias("r"))
    return whole.unionByName(lines).where("r is not null").select("r.*", "source_file")


def _typed(schema: str) -> str:
    """A column list as the fields of a struct."""
    return ", ".join(f"{f.name}:{f.dataType.simpleString()}" for f in StructType.fromDDL(schema))


def file_counts(records: DataFrame, sections: DataFrame, text: str = "section_content_expanded") -> DataFrame:
    """By source_file: records, sections, and the mean and greatest length of the sections' texts."""
    n = records.groupBy("source_file").agg(F.count("*").alias("records"))
    made = sections.groupBy("source_file").agg(F.count("*").alias("sections"), F.round(F.avg(F.length(text)), 6).alias("mean_length"), F.max(F.length(text)).alias("max_length"))
    return n.join(made, "source_file", "left").withColumn("sections", F.coalesce("sections", F.lit(0)))


def entity_lines(mentions: DataFrame, sections: DataFrame | None = None) -> DataFrame:
    """One row per section with its mentions, ordered by place, as an array; with ``sections``, empty ones too."""
    cols = [c for c in mentions.columns if c != "section_id"]
    order = ["start", "end", *[c for c in cols if c not in ("start", "end")]]
    lines = mentions.groupBy("section_id").agg(F.array_sort(F.collect_list(F.struct(*order))).alias("entities"))
    if sections is None:
        return lines
    joined = sections.select("section_id").distinct().join(lines, "section_id", "left")
    return joined.withColumn("entities", F.coalesce("entities", F.array().cast(lines.schema["entities"].dataType)))


def write_lines(lines: DataFrame, path: str, mode: str = "append", by: str | None = None) -> None:
    writer = lines.write.mode(mode)
    (writer.partitionBy(by) if by else writer).json(path)


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """Flat mentions of entity lines."""
    return spark.read.schema(ENTITIES).json(path).select("section_id", F.inline_outer("entities").alias("entity", "text", "score", "start", "end", "model", "domain", "own_section", "linking", "type_mismatch")).drop("own_section")


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary file, all strings, missing values empty, with ord in file order (rows of one file)."""
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path).fillna("")
    return raw.withColumn("ord", F.monotonically_increasing_id())


def text_column(frame: DataFrame) -> Column:
    """The first non-empty of the section text columns that ``frame`` has."""
    have = [c for c in ("section_content_expanded", "section_content", "text", "content") if c in frame.columns]
    return F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in have], F.lit(""))
