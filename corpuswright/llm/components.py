"""Connected components of an undirected graph given as a table of edges.

Large-star and small-star steps alternate until the edges no longer change. Every step
is one minimum per node, combined inside the map tasks, and one join with the minima.
The minima are written first, so that the join shuffles both sides and adaptive
execution can divide a node with very many edges. Edges and labels stay distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpuswright.sources.staging import stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.inline(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
    )))
    least = stage(both.groupBy("u").agg(F.min("v").alias("m")), "star")
    return (
        both.filter("v > u").join(least, "u")
        .select(F.least("u", "m").alias("a"), F.col("v").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = stage(edges.groupBy("b").agg(F.min("a").alias("m")), "star")
    moved = edges.join(least, "b").filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node reaches, for nodes with an edge.

    edges: columns a and b of one orderable type. Loops, repeated edges and nulls are
    ignored. The number of rounds grows with the logarithm of the longest path.
    """
    ordered = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    current = stage(ordered.distinct(), "edges")
    seen = _checksum(current)
    while seen[0]:
        current = stage(_small_star(stage(_large_star(current), "edges")), "edges")
        now = _checksum(current)
        if now == seen:
            break
        seen = now
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
    ).first()
    return tuple(row)
