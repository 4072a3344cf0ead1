"""Annotation samples: seeded, capped by mention, stratified; statistics.

Defined results: null texts and groups are a value like others; repeated keys are drawn together; a sample larger than
its table is the table; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Into how many parts a group is ranked first.
PARTS = 64


def draw(seed: int, *columns: str) -> Column:
    """A reproducible order: the md5 of the seed and the row's key."""
    return F.md5(F.concat_ws("#", F.lit(str(seed)), *columns))


def _first(frame: DataFrame, keys: list[Column], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def capped(frame: DataFrame, key: str, per_mention: int = 2, n: int | None = None, seed: int = 42) -> DataFrame:
    """At most ``per_mention`` rows of each lower-cased text, then ``n`` rows."""
    some = _first(frame, [F.lower("text")], [draw(seed, key), F.col(key)], per_mention)
    return some if n is None else some.orderBy(draw(seed, key), key).limit(n)


def stratified(frame: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """max(1, n // groups) rows of each group, topped up from the rest, ``n`` in all; no row twice."""
    groups = max(1, frame.select(group).distinct().count())
    # no row past the first n of its part of a group can be drawn, so a large group is never sorted in one task
    part = F.pmod(F.xxhash64(key), F.lit(PARTS))
    frame = _first(frame, [F.col(group), part], [draw(seed, key), F.col(key)], n)
    w = Window.partitionBy(group).orderBy(draw(seed, key), key)
    ranked = frame.withColumn("_n", F.row_number().over(w)).withColumn("_more", F.col("_n") > max(1, n // groups))
    return ranked.orderBy("_more", draw(seed, key), key).limit(n).drop("_n", "_more")


def with_unlinked(frame: DataFrame, key: str, n: int, ratio: float = 0.2, seed: int = 42) -> DataFrame:
    """int(n x ratio) unlinked rows and linked ones for the rest; a side that is short is filled by the other."""
    want = int(n * ratio)
    linked, unlinked = frame.where("linked_id is not null"), frame.where("linked_id is null")
    a = linked.orderBy(draw(seed, key), key).limit(n).count()
    b = unlinked.orderBy(draw(seed, key), key).limit(n).count()
    u = min(b, max(want, n - a))
    return unlinked.orderBy(draw(seed, key), key).limit(u).unionByName(linked.orderBy(draw(seed, key), key).limit(n - u))


def weighted_files(files: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` files (path, size) without replacement, chances by size (exponential keys from a seeded hash)."""
    u = (F.pmod(F.xxhash64(F.lit(seed), "path"), F.lit(1 << 52)) + 1) / float((1 << 52) + 1)
    return files.where("size > 0").orderBy(-F.log(u) / F.col("size"), "path").limit(n)


def balanced_files(counts: DataFrame, n: int) -> DataFrame:
    """Documents (doc_id, model, n): n // models by model where a model is strongest, filled up by total."""
    models = max(1, counts.select("model").distinct().count())
    best = _first(counts, [F.col("model")], [F.desc("n"), F.col("doc_id")], max(1, n // models)).select("doc_id").distinct().withColumn("_first", F.lit(0))
    total = counts.groupBy("doc_id").agg(F.sum("n").alias("n")).join(best, "doc_id", "left")
    return total.orderBy(F.coalesce("_first", F.lit(1)), F.desc("n"), "doc_id").limit(n).select("doc_id")


def statistics(frame: DataFrame, by: str) -> DataFrame:
    return frame.groupBy(by).agg(F.count("*").alias("n"), F.countDistinct(F.lower("text")).alias("distinct_mentions"), F.round(F.avg(F.length("text")), 6).alias("avg_length"))


def value_counts(frame: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """(value, n) of a column, most frequent first, then by value; the first ``n`` if given. Nulls count as a value."""
    made = frame.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")
    return made if n is None else made.limit(n)


def model_balanced(frame: DataFrame, key: str, n: int, per_mention: int = 3, seed: int = 42) -> DataFrame:
    """A sample of ``n`` rows with an equal share of each linking_model, at most ``per_mention`` of a mention in each."""
    from quillspark.operators.annotate import two_level

    return two_level(frame, "linking_model", key, n, per_mention, seed)
