"""Deduplication by link, anti-join with what was seen, incremental merge of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _whole(rows: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in rows.columns]


def dedup_first(rows: DataFrame, link: str, order: list, blank_exempt: bool = False) -> DataFrame:
    """The first row of each link, ``order`` upwards; with ``blank_exempt`` rows without a link all stay.

    The first rows are combined before the shuffle, keyed by a SHA-256 digest, so a link (or none) may be in any share of the rows.
    """
    blank = F.coalesce(F.col(link), F.lit("")) == ""
    keyed = rows.filter(~blank) if blank_exempt else rows
    first = F.min_by(F.struct(*_whole(rows)), F.struct(*order, F.xxhash64(*_whole(rows))))
    kept = keyed.groupBy(F.sha2(F.col(link).cast("binary"), 256).alias("_key")).agg(first.alias("_row")).select("_row.*")
    return kept.unionByName(rows.filter(blank)) if blank_exempt else kept


def unseen(rows: DataFrame, seen: DataFrame, link: str, order: list) -> DataFrame:
    """Rows whose link's SHA-1 is not in ``seen`` (column hash), the first of each link."""
    hashed = rows.withColumn("hash", F.sha1(F.col(link).cast("binary")))
    return dedup_first(hashed.join(seen.select("hash").distinct(), "hash", "left_anti"), "hash", order)


def merge(existing: DataFrame, new: DataFrame, link: str, order: list) -> DataFrame:
    """Existing rows win over new ones with the same link."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return dedup_first(both, link, [F.col("_new"), *order], blank_exempt=True).drop("_new")


def added(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: how many rows there are more, and the same with losses as 0."""
    sides = before.select(F.lit(-1).alias("s")).unionAll(after.select(F.lit(1).alias("s")))
    return sides.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("added")).withColumn("shown", F.greatest("added", F.lit(0)))


def key_union(*keys: DataFrame) -> DataFrame:
    out = keys[0]
    for more in keys[1:]:
        out = out.union(more)
    return out.distinct()


def key_difference(keys: DataFrame, without: DataFrame) -> DataFrame:
    """Keys that ``without`` lacks, nulls compared as values."""
    on = None
    other = without.toDF(*[f"_{c}" for c in keys.columns])
    for c in keys.columns:
        same = F.col(c).eqNullSafe(F.col(f"_{c}"))
        on = same if on is None else on & same
    return keys.distinct().join(other, on, "left_anti")


def day_digest(rows: DataFrame, day: str) -> DataFrame:
    columns = sorted(c for c in rows.columns if c != day)
    return rows.groupBy(day).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*columns)).alias("x"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("s"))


def changed_days(before: DataFrame, after: DataFrame, day: str) -> DataFrame:
    """Days whose rows differ, with ``emptied`` for those that have none any more."""
    a, b = day_digest(before, day), day_digest(after, day).withColumnRenamed(day, "_d")
    joined = a.join(b, F.col(day).eqNullSafe(F.col("_d")), "full_outer")
    same = a.n.eqNullSafe(b.n) & a.x.eqNullSafe(b.x) & a.s.eqNullSafe(b.s)
    return joined.filter(~same).select(F.coalesce(day, "_d").alias(day), b.n.isNull().alias("emptied"))
