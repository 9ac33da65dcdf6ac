"""Connected components of a graph of edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dryspell.lineage import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the smallest node reachable.

    Edges are rewired to the smallest neighbour, first those to larger nodes, then those to smaller ones,
    until nothing changes. A hub is never gathered: its smallest neighbour is found by aggregation.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, mark = materialize(edges), None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rewired = large.join(least, "u")
        small = rewired.select("u", F.col("m").alias("v")).union(
            rewired.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges = materialize(small.distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()
        if state == mark:
            break
        mark = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
