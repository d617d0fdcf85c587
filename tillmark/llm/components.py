"""Connected components of an edge table, by turns of large-star and small-star.

No round holds a component in one task: a node's smallest neighbour is found by a combining aggregate, and the edges of
a node with very many neighbours are joined to that one row, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.shared import stored

MAX_ROUNDS = 60


def _star(pairs: DataFrame, least: DataFrame, keep) -> DataFrame:
    """Every neighbour that ``keep`` names, tied to the smallest of the node's neighbourhood."""
    return pairs.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (u, v: long), the component named by its smallest node.

    Edges may repeat and point either way; loops are ignored, so a node with nothing but a loop is not returned.
    """
    u, v = F.col("u"), F.col("v")
    edges = edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    edges = stored(edges)
    seen = None
    for _ in range(MAX_ROUNDS):
        both = edges.unionByName(edges.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _star(both, least, v > u).where(u != v).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _star(large, least, v != F.col("m")).unionByName(least.select("u", F.col("m").alias("v")))
        small = small.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
        edges = stored(small)
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == seen:
            own = edges.select(v.alias("node")).distinct().withColumn("component", F.col("node"))
            return edges.select(u.alias("node"), v.alias("component")).unionByName(own)
        seen = now
    raise RuntimeError(f"{MAX_ROUNDS} rounds did not settle the components")
