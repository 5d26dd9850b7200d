"""Connected components by alternating star operations, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm.common import discard, materialise


def _settled(edges: DataFrame) -> bool:
    """Whether every larger node has one edge and none is a smaller node too: the edges are stars, that is, the components."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    return ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above")).filter("below > 1 or below = 1 and above = 1").count() == 0


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``component`` (its least node) of every node of ``links`` (columns a, b), as a table of ``materialise``.

    The largest table of a round goes with the round after it. Links of a node with itself are dropped; without links there are no rows.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialise(edges, "edges")
    for _ in range(most_rounds):
        if _settled(edges):
            break
        last, edges = edges, materialise(_small_star(_large_star(edges)), "edges")
        discard(last)
    else:
        raise RuntimeError("components did not settle")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = materialise(nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "nodes")
    discard(edges)
    return found
