"""Rendezvous hashing of record keys over weighted shards, with DataFrame functions only.

A record goes to the shard with the least ``-ln(u) / weight``, where ``u`` in (0, 1) is a hash of the key and the shard's
number. One more shard takes records only into itself, and each shard's share is its weight's. No record's shard
depends on another record, so nothing is shuffled to place records; only the gapless slots need a shuffle, and that of a
few numbers a record.

Cases: a text of any length is only measured and hashed; a null key is a key of its own; a null text has size 1 and the CRC of no bytes; an empty table gives an
empty result; rows that repeat wholly get the same shard and neighbouring slots; columns other than the key and the text
are not read, so their names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.llm.common import documents, row_count, spread_copies

#: Rows that one slot block holds on average; a block is one key of a window.
BLOCK_ROWS = 8192


def shard_cost(key: Column, shard: int, weight: float = 1.0) -> Column:
    """The cost of a key at a shard; the least cost wins, ties go to the lower number."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    return F.struct((-F.log((bits.cast("double") + 0.5) * 2.0**-53) / F.lit(float(weight))).alias("cost"), F.lit(shard).alias("shard"))


def choose_shard(key: Column, weights: list[float]) -> Column:
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("every shard needs a positive weight")
    costs = [shard_cost(key, i, w) for i, w in enumerate(weights)]
    return F.least(*costs) if len(costs) > 1 else costs[0]


def assign_shards(docs: DataFrame, n_shards: int = 16, weights: list[float] | None = None, grown_weight: float = 1.0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, size, text_crc32, law, shard, slot and grown_shard (with one more shard) of every row.

    Slots come from a two-level prefix sum: counts of hashed blocks inside a shard are summed over the blocks, then rows
    are numbered inside their block. Rows that are alike in key, size and CRC are counted before the shuffle and spread
    out again after it, so that one key may hold any share of the rows.
    """
    weights = weights or [1.0] * n_shards
    blocks = max(64, math.ceil(row_count(docs) / len(weights) / BLOCK_ROWS))
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(key).alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    same = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    best = choose_shard(F.col("doc_id"), weights)
    placed = same.withColumn("best", best).select(
        "*",
        F.col("best.shard").alias("shard"),
        F.least(F.col("best"), shard_cost(F.col("doc_id"), len(weights), grown_weight))["shard"].alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.lit(-1)), F.lit(blocks)).cast("int").alias("block"),
    )
    counts = placed.groupBy("shard", "block").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "block").orderBy("doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("upto", F.sum("copies").over(inside)).join(starts, ["shard", "block"]).withColumn("first", F.col("start") + F.col("upto") - F.col("copies"))
    spread = spread_copies(numbered, "copies", "number")
    return spread.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("number")).alias("slot"), "grown_shard")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir), n_shards=16)
