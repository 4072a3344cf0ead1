"""Domain settings: vocabularies, recognisers, linkers, filters and type maps, and how a linking run is resolved."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from pathlib import PurePath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.filters import MentionFilter
from quillspark.operators.vocabulary import lookup

#: A part of a vocabulary file's name, and the source its links carry.
SOURCES = (("IRENA", "IRENA"), ("Neuroscience", "OPENMINDS-UBERON"), ("UBERON", "OPENMINDS-UBERON"), ("Vessel", "Maritime-Ontology"), ("Maritime", "Maritime-Ontology"), ("CCAM", "SINFONICA-FAME"))
#: The type of a mention whose entry has none, by domain, and the maps of entry types that aren't the identity.
DEFAULT_TYPE = {"energy": "energytype", "maritime": "vesselType", "neuro": "UBERONParcellation", "ccam": "General terms related to CCAM"}
TYPE_MAP = {"energy": ({"Storage": "energystorage"}, "energytype"), "maritime": ({}, "vesselType")}


def source_of(path: Column) -> Column:
    """The source of a vocabulary by its file's name; the name without its suffix where none is known."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")
    return reduce(lambda w, kv: w.when(stem.contains(kv[0]), kv[1]), SOURCES[1:], F.when(stem.contains(SOURCES[0][0]), SOURCES[0][1])).otherwise(stem)


def mention_type(entry_type: Column, domain: str, default: str = "") -> Column:
    """The mention type of an entry's type: the domain's map, or the type itself; blank and null have the default."""
    named, other = TYPE_MAP.get(domain, ({}, None))
    mapped = F.lit(other) if other else entry_type
    for k, v in named.items():
        mapped = F.when(entry_type == k, v).otherwise(mapped)
    return F.when(F.trim(F.coalesce(entry_type, F.lit(""))) == "", default or DEFAULT_TYPE.get(domain, "Unknown")).otherwise(mapped)


@dataclass
class Linker:
    """How mentions of one type are linked: a vocabulary's name, its source, and what is tried where it has no entry."""

    vocabulary: str
    source: str
    fallback: str | None = None
    blocked: frozenset[str] = frozenset()


@dataclass
class Domain:
    name: str
    strategy: str = "semantic"
    linkers: dict[str, Linker] = field(default_factory=dict)
    el_config: dict = field(default_factory=dict)
    blocked: set[str] | dict = field(default_factory=set)
    min_length: int | dict = 1
    type_mapping: dict[str, list[str]] = field(default_factory=dict)

    def mention_filter(self) -> MentionFilter:
        """The domain's filter; linkers' own blocked terms hold for their type."""
        made = MentionFilter.of(self.blocked, self.min_length)
        for kind, linker in self.linkers.items():
            if linker.blocked:
                made.blocked[kind.lower()] = made.blocked.get(kind.lower(), set()) | {t.lower() for t in linker.blocked}
        return made


@dataclass
class Run:
    strategy: str
    linker: str
    model: str
    reranker: str
    threshold: float
    context_window: int
    max_contexts: int
    use_sentence_context: bool
    top_k: int
    fallbacks: bool
    source: str


def resolve(domain: Domain, **given) -> Run:
    """A run's settings: those given, else the domain's, else the defaults.

    The linker ``auto`` is the reranker where either model's name has "qwen", the instruct linker where the model's has
    "instruct", else the semantic one.
    """
    default = {"linker_type": "auto", "el_model_name": "stand-in", "reranker_llm": "stand-in", "threshold": 0.8, "context_window": 5, "max_contexts": 5, "use_sentence_context": False, "reranker_top_k": 7, "reranker_fallbacks": True, "taxonomy_source": "IRENA"}
    unknown = given.keys() - default.keys()
    if unknown:
        raise ValueError(f"no such settings: {sorted(unknown)}")
    value = {k: next(x for x in (given.get(k), domain.el_config.get(k), d) if x is not None) for k, d in default.items()}
    names = f"{value['el_model_name']} {value['reranker_llm']}".lower()
    linker = value["linker_type"]
    if linker == "auto":
        linker = "reranker" if "qwen" in names else "instruct" if "instruct" in value["el_model_name"].lower() else "semantic"
    return Run(domain.strategy, linker, value["el_model_name"], value["reranker_llm"], value["threshold"], value["context_window"], value["max_contexts"], value["use_sentence_context"], value["reranker_top_k"], value["reranker_fallbacks"], value["taxonomy_source"])


def build_lookups(vocabularies: dict[str, DataFrame | None], extra: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One lookup table of several vocabularies, with ``vocabulary``; absent ones are left out.

    ``extra`` names, by vocabulary, columns whose ``|``-parted values are synonyms too.
    """
    made = []
    for name, vocab in vocabularies.items():
        if vocab is None:
            continue
        more = [c for c in (extra or {}).get(name, ()) if c in vocab.columns]
        full = vocab.withColumn("synonyms", F.concat_ws("|", *[F.when(F.col(c) != "", F.col(c)) for c in ("synonyms", *more)]))
        made.append(lookup(full).withColumn("vocabulary", F.lit(name)))
    if not made:
        raise ValueError("no vocabulary")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), made)


def sample_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(domain, path) of annotation sample files: the domain from a folder ``X-all-ft``, else from the name's first part."""
    found = spark.createDataFrame([(p, PurePath(p).parent.name, PurePath(p).stem) for p in paths], "path string, folder string, stem string")
    return found.select(F.when(F.col("folder").endswith("-all-ft"), F.regexp_replace("folder", "-all-ft$", "")).otherwise(F.substring_index("stem", "_", 1)).alias("domain"), "path")


def vocabulary_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(domain, path) of vocabulary files by their folder; enriched ones are left out."""
    found = spark.createDataFrame([(PurePath(p).parent.name, p, PurePath(p).stem) for p in paths], "domain string, path string, stem string")
    return found.where(~F.col("stem").endswith("_enriched")).select("domain", "path")
