"""Connected components of a link table, by alternating star contractions.

Large-star: every neighbour above a node links to the smallest of the node's neighbourhood;
small-star: a node and its smaller neighbours link to the smallest of them. Both keep components
and the number of rounds grows with the logarithm of their size. Each half-round is an aggregate
with map-side combine and a join, so a node with very many links is split like any skewed join.
Tables between rounds are written to the shared folder; nothing returns but two figures a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventflow.llm.shared import Tables


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("low"))
    low = low.select("u", F.least("u", "low").alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """``edges`` (u, v) of two long columns to (node, component): the smallest node reachable, for
    every node that has an edge and is not itself the smallest."""
    edges = tables.put(edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
                       .where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        edges = tables.put(_small_star(_large_star(edges)), "star")
        got = edges.agg(F.count("*").alias("n"), F.sum(F.hash("u", "v").cast("long")).alias("h")).head()
        if (got["n"], got["h"]) == seen or not got["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = (got["n"], got["h"])
