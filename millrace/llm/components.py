"""Connected components of a graph given by its edges, as a few rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import keep


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge: columns ``node, root``.

    ``edges`` has two columns of node numbers. Every round links larger neighbours of a node to its smallest
    neighbour, then smaller ones, until the edges are stars; the number of rounds grows with the logarithm of
    the longest path. Rounds are written to the shared folder.
    """
    a, b = edges.columns
    graph = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    graph, before = keep(graph, "edges"), None
    while True:
        mark = graph.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                         F.bit_xor(F.xxhash64("v", "u")).alias("y")).first()
        if mark == before or not mark["n"]:
            return graph.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                graph.select(F.col("v"), F.col("v"))).distinct()
        before = mark
        both = graph.union(graph.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        # Larger neighbours move to the smallest neighbour of their node.
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = keep(large.filter("u <> v"), "edges")
        # Then smaller neighbours do.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        graph = keep(moved.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
