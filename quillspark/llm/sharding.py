"""Sharding by balanced label propagation.

Documents are linked if their texts are equal. Every document starts in a shard by the hash of its id; then, round by
round, linked documents move towards the shard where most of their neighbours are, as far as that shard's capacity
lets them in, which lessens cut links. As the members of a group of equal texts are interchangeable, the rounds run on
counts by (group, shard) - joins and aggregates of a table far smaller than the documents - and a group of any size
(a third of all rows, say) is never gathered. Documents without links fill the shards up.

The law is ``rows``: shard counts differ by one at most. Ranks are taken within hash buckets of bounded size and
offset by bucket totals, so no task sorts a shard. Propagation ends when no document moves, or after ``rounds`` rounds.

Defined results: a null text is a text of 0 bytes, linked with other null texts only; null doc_ids and repeated rows
are rows like others; an empty table gives no rows; with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from quillspark.llm.common import checkpointed

BUCKET_ROWS = 50_000


def ranked(df: DataFrame, keys: list[str], order: list[Column], buckets: int, salt: Column, name: str) -> DataFrame:
    """``df`` with its gapless rank from 0 within ``keys``, in the order of (hash bucket of ``salt``, ``order``).

    Only a bucket is sorted in one task; the offsets come from an aggregate of keys x buckets rows.
    """
    made = df.withColumn("_b", F.pmod(salt, F.lit(buckets)).cast("int"))
    sums = made.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
    whole = W.Window.partitionBy(*keys).orderBy("_b").rowsBetween(W.Window.unboundedPreceding, -1)
    offsets = sums.select(*keys, "_b", F.coalesce(F.sum("_n").over(whole), F.lit(0)).alias("_before"))
    inside = W.Window.partitionBy(*keys, "_b").orderBy(*order)
    own = made.withColumn("_within", F.row_number().over(inside) - 1)
    return own.join(offsets, [*keys, "_b"]).withColumn(name, F.col("_before") + F.col("_within")).drop("_b", "_n", "_before", "_within")


def _by_list(index: Column, values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), index + 1)


def propagate(tally: DataFrame, load: list[int], capacity: int, rounds: int) -> DataFrame:
    """(grp, shard, n) after label propagation of the groups in ``tally``.

    ``load`` is the shards' count of linked documents, ``capacity`` how many a shard takes. In a round every group picks
    the shard with most of its members among those with room (ties by hash), all its members elsewhere ask to move
    there, and requests are granted by falling share of the group until the room is used; the last one in part.
    """
    shards = len(load)
    for turn in range(rounds):
        room = [max(0, capacity - x) for x in load]
        open_ = _by_list(F.col("shard"), room) > 0
        pull = tally.where(open_).groupBy("grp").agg(F.max_by("shard", F.struct("n", F.xxhash64("grp", "shard"))).alias("to"), F.max("n").alias("at"))
        asked = tally.join(pull, "grp").where("shard <> to and n <= at")  # members of a larger part stay
        # grants by target: requests are ordered within hash buckets, most members first between buckets of like gain
        asks = checkpointed(asked.groupBy("grp", "to").agg(F.sum("n").alias("want"), F.first("at").alias("at")).withColumn("gain", F.log2("at").cast("int")))
        by_gain = asks.groupBy("to", "gain", F.pmod(F.xxhash64("grp"), F.lit(256)).alias("b")).agg(F.sum("want").alias("want"))
        before = W.Window.partitionBy("to").orderBy(F.desc("gain"), "b").rowsBetween(W.Window.unboundedPreceding, -1)
        starts = by_gain.select("to", "gain", "b", F.coalesce(F.sum("want").over(before), F.lit(0)).alias("start"))
        inside = W.Window.partitionBy("to", "gain", "b").orderBy("grp").rowsBetween(W.Window.unboundedPreceding, -1)
        lined = asks.withColumn("b", F.pmod(F.xxhash64("grp"), F.lit(256))).withColumn("own", F.coalesce(F.sum("want").over(inside), F.lit(0))).join(starts, ["to", "gain", "b"])
        left = _by_list(F.col("to"), room) - F.col("start") - F.col("own")
        granted = lined.select("grp", "to", F.greatest(F.lit(0), F.least("want", left)).alias("give")).where("give > 0")
        # a group gives up its members from its shards in order until the grant is used
        at = W.Window.partitionBy("grp").orderBy("shard").rowsBetween(W.Window.unboundedPreceding, -1)
        leaving = asked.join(granted, ["grp", "to"]).withColumn("_before", F.coalesce(F.sum("n").over(at), F.lit(0))).select("grp", "shard", "to", F.greatest(F.lit(0), F.least(F.col("n"), F.col("give") - F.col("_before"))).alias("out")).where("out > 0")
        leaving = checkpointed(leaving)
        moved = leaving.agg(F.sum("out")).first()[0]
        if not moved:
            break
        change = leaving.select("grp", "shard", (-F.col("out")).alias("n")).unionByName(leaving.select("grp", F.col("to").alias("shard"), F.col("out").alias("n")))
        tally = checkpointed(tally.unionByName(change).groupBy("grp", "shard").agg(F.sum("n").alias("n")).where("n > 0"))
        load = [0] * shards
        for r in tally.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            load[r["shard"]] = r["n"]
    return tally


def shard(docs: DataFrame, shards: int = 24, rounds: int = 60, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = checkpointed(docs.select("doc_id", (F.length(body) + 8).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.when(F.col("text").isNull(), F.lit("null")).otherwise(F.md5(body)).alias("grp")))
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    start = F.pmod(F.xxhash64("doc_id", "grp"), F.lit(shards)).cast("int")
    linked = rows.groupBy("grp").agg(F.count("*").alias("members")).where("members > 1")
    own = rows.join(linked, "grp", "left").withColumn("first_shard", start)
    tally = checkpointed(own.where("members > 1").groupBy("grp", F.col("first_shard").alias("shard")).agg(F.count("*").alias("n")))
    load = [0] * shards
    for r in tally.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        load[r["shard"]] = r["n"]
    settled = propagate(tally, load, total // shards, rounds)
    # members of a group take its shards in order of their rank within the group
    ends = W.Window.partitionBy("grp").orderBy(F.desc("n"), "shard")
    spans = settled.select("grp", "shard", (F.sum("n").over(ends) - F.col("n")).alias("lo"), F.sum("n").over(ends).alias("hi"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("size")]
    members = ranked(own.where("members > 1").select("doc_id", "size", "text_crc32", "grp"), ["grp"], order, buckets, F.xxhash64("doc_id"), "_place")
    placed = members.join(spans, "grp").where((F.col("_place") >= F.col("lo")) & (F.col("_place") < F.col("hi"))).select("doc_id", "size", "text_crc32", "grp", "shard", F.lit(0).alias("single"))
    singles = own.where("members is null").select("doc_id", "size", "text_crc32", "grp", F.col("first_shard").alias("shard"), F.lit(1).alias("single"))
    at = checkpointed(placed.unionByName(singles))
    # linked documents come first in a shard, so those past its quota are as far as possible unlinked ones
    fine = ranked(at, ["shard", "single"], [*order, F.col("grp")], buckets, F.xxhash64("doc_id", "grp"), "_rank")
    held, lone = [0] * shards, [0] * shards
    for r in at.groupBy("shard").agg(F.count("*").alias("n"), F.sum(1 - F.col("single")).alias("linked")).collect():
        held[r["shard"]], lone[r["shard"]] = r["n"], r["linked"]
    # the shards that hold most get the quotas that are one larger
    larger = set(sorted(range(shards), key=lambda s: (-held[s], s))[: total % shards])
    quota = [total // shards + (s in larger) for s in range(shards)]
    line = checkpointed(fine.withColumn("_slot", F.col("_rank") + F.col("single") * _by_list(F.col("shard"), lone)).drop("_rank"))
    stays = F.col("_slot") < _by_list(F.col("shard"), quota)
    kept = line.where(stays).select("doc_id", "size", "text_crc32", "shard", F.col("_slot").alias("slot"))
    over = line.where(~stays).withColumn("_over", F.col("_slot") - _by_list(F.col("shard"), quota))
    starts, deficits = [0], [0]
    for s in range(shards):
        starts.append(starts[-1] + max(0, held[s] - quota[s]))
        deficits.append(deficits[-1] + max(0, quota[s] - held[s]))
    pool = over.withColumn("_pool", F.col("_over") + _by_list(F.col("shard"), starts))
    to = sum(((F.col("_pool") >= d).cast("int") for d in deficits[1:-1]), F.lit(0))
    filled = pool.withColumn("_to", to).select("doc_id", "size", "text_crc32", F.col("_to").alias("shard"), (F.col("_pool") - _by_list(F.col("_to"), deficits) + _by_list(F.col("_to"), held)).alias("slot"))
    return kept.unionByName(filled).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
