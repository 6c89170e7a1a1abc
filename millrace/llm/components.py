"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least id it sees."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("low"))
    least = least.select(F.col("a").alias("node"), F.least("a", "low").alias("low"))
    grown = both.filter(F.col("b") > F.col("a")).join(least, F.col("a") == F.col("node"))
    return grown.select(F.col("low").alias("a"), "b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("low")).select(F.col("b").alias("node"), "low")
    moved = edges.join(least, F.col("b") == F.col("node"))
    return (
        moved.select(F.col("low").alias("x"), F.col("a").alias("y"))
        .unionByName(moved.select(F.col("low").alias("x"), F.col("b").alias("y")))
        .filter("x <> y")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b), a < b; component is the least node.

    Only nodes with an edge appear, the least one of a component too. The
    number of rounds grows with the logarithm of the longest path. Lineage is
    cut each round.
    """
    edges = cut_lineage(edges.select("a", "b").distinct())
    mark = None
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        # settled when every node hangs on one smaller node that hangs on none itself
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    leaves = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return leaves.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))
