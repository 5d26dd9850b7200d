"""Outlet names: bans and aliases, exact or by prefix.

A prefix fits a name that equals it or goes on with a space. So a name is looked up by what stands before each of its spaces, and by
itself. A list that fits into a literal is looked up row by row in hash sets; a longer one meets the distinct names in an equi-join, and
the rows get what was found for their names, by a broadcast where it was measured to be small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.text import once, strip
from presslens.operators.lookup import LITERAL_BYTES, in_map, sized


@dataclass(frozen=True)
class Patterns:
    """(pattern, canonical, is_prefix, order of listing)."""

    spark: SparkSession
    rows: tuple[tuple[str, str, bool, int], ...]

    @property
    def size(self) -> int:
        return sum(len(p.encode()) + len(c.encode()) for p, c, _, _ in self.rows)

    def pairs(self, prefixes: bool) -> dict[str, str]:
        """Pattern to canonical name; of one pattern the first listed counts."""
        found: dict[str, str] = {}
        for pattern, canonical, is_prefix, _ in self.rows:
            if is_prefix == prefixes:
                found.setdefault(pattern, canonical)
        return found

    def table(self) -> DataFrame:
        return self.spark.createDataFrame(list(self.rows), "pattern string, canonical string, is_prefix boolean, ord int")


def patterns(spark: SparkSession, names: list[tuple[str, str]]) -> Patterns:
    """(name, canonical) pairs; a name that ends in ``*`` is a prefix. A later line with the same name replaces an earlier one."""
    last = {}
    for order, (name, canonical) in enumerate(names):
        last[name] = (name[:-1].rstrip() if name.endswith("*") else name, canonical, name.endswith("*"), order)
    return Patterns(spark, tuple(last.values()))


def _starts(name: Column) -> Column:
    words = F.split(name, " ", -1)
    return F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.array_join(F.slice(words, F.lit(1), i), " "))


def _among(value: Column, names: dict[str, str]) -> Column:
    return value.isin(*names) if names else F.lit(False)


def is_banned(media: Column, bans: Patterns) -> Column:
    """Whether a ban fits the name; a list for a literal only."""
    exact, prefixes = bans.pairs(False), bans.pairs(True)
    return F.coalesce(once(strip(media), lambda name: _among(name, exact) | F.exists(_starts(name), lambda s: _among(s, prefixes))), F.lit(False))


def canonical_name(media: Column, aliases: Patterns) -> Column:
    """Exact alias first, then the longest prefix, then the first listed, else the trimmed name itself; a list for a literal only."""
    exact, prefixes = aliases.pairs(False), aliases.pairs(True)

    def named(name: Column) -> Column:
        longest = F.get(F.reverse(F.filter(_starts(name), lambda s: _among(s, prefixes))), 0)
        return F.coalesce(in_map(name, exact), in_map(longest, prefixes), name)

    return once(strip(media), named)


def _fits(rows: DataFrame, listed: Patterns, media: str) -> DataFrame:
    """_name (as it is in ``rows``) with each pattern that fits it."""
    names = rows.select(F.col(media).alias("_name")).distinct().withColumn("_plain", strip(F.col("_name")))
    starts = names.select("_name", "_plain", F.explode(_starts(F.col("_plain"))).alias("pattern"))
    return starts.join(sized(listed.table()), "pattern").filter(F.col("is_prefix") | (F.col("pattern") == F.col("_plain")))


def flag_banned(rows: DataFrame, bans: Patterns, media: str, flag: str, most: int = LITERAL_BYTES) -> DataFrame:
    """``rows`` plus ``flag``: whether a ban fits the outlet."""
    if bans.size <= most:
        return rows.withColumn(flag, is_banned(F.col(media), bans))
    banned = _fits(rows, bans, media).select("_name").distinct().withColumn("_hit", F.lit(True))
    joined = rows.join(sized(banned), F.col(media) == F.col("_name"), "left")
    return joined.withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_name", "_hit")


def without_banned(rows: DataFrame, bans: Patterns, media: str = "media", most: int = LITERAL_BYTES) -> DataFrame:
    """Rows of outlets that no ban fits; a row without an outlet stays."""
    return flag_banned(rows, bans, media, "_banned_outlet", most).filter("NOT _banned_outlet").drop("_banned_outlet")


def canonical_names(rows: DataFrame, aliases: Patterns, media: str = "media", most: int = LITERAL_BYTES) -> DataFrame:
    """``rows`` plus ``canonical``."""
    if aliases.size <= most:
        return rows.withColumn("canonical", canonical_name(F.col(media), aliases))
    rank = F.struct(~F.col("is_prefix"), F.length("pattern"), -F.col("ord"))
    best = _fits(rows, aliases, media).groupBy("_name").agg(F.max_by("canonical", rank).alias("_canonical"))
    joined = rows.join(sized(best), F.col(media) == F.col("_name"), "left")
    return joined.withColumn("canonical", F.coalesce("_canonical", strip(F.col(media)))).drop("_name", "_canonical")
