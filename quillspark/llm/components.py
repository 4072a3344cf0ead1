"""Connected components of an edge table by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import checkpointed


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star step: a node's neighbours are tied to the least of them and the node, by aggregates and an equi-join."""
    if small:  # every node keeps its smaller neighbours
        both = edges
    else:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    tied = both.join(least, "u")
    if small:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b), root the least node it can reach.

    Every round is checkpointed. Hot nodes need no special case: their edges are pre-aggregated to a minimum, and the
    joins are on a unique side, which adaptive execution splits. Self-links and repeated edges are allowed, null ends
    are ignored, an empty table gives no rows.
    """
    now = checkpointed(edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = None
    for _ in range(most_rounds):
        new = checkpointed(_stars(_stars(now, small=False), small=True))
        row = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        now = new
        if tuple(row) == mark:
            break
        mark = tuple(row)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
