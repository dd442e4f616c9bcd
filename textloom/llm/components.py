"""Connected components of an edge table, by alternating large and small stars.

Every step is a grouped minimum and a join on written tables; nothing reaches the driver but the number
of moved edges, which is observed while a step is written and tells when the stars no longer change.  No
step makes more edges than it reads, so only the given ones are made distinct.  A node with very many
edges is counted before the shuffle, and its rows are split by adaptive execution in the join.
"""

from __future__ import annotations

from itertools import cycle

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textloom.sources.scratch import materialise


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of the edges ``a, b``: the smallest node it is linked with."""
    pairs = materialise(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    if pairs.isEmpty():
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("label"))
    still = 0
    for star in cycle((_large_star, _small_star)):
        pairs, moved = star(pairs)
        still = 0 if moved else still + 1
        # Edges that neither star moves are stars around their smallest nodes.
        if still == 2:
            break
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        roots.withColumn("label", F.col("node"))
    )


def _observed(rows: DataFrame, moves: Column) -> tuple[DataFrame, Observation]:
    moved = Observation()
    return rows.observe(moved, F.count(F.when(moves, 1)).alias("moved")), moved


def _large_star(pairs: DataFrame) -> tuple[DataFrame, int]:
    """Link every larger neighbour of a node to the smallest node around it; and how many that moves."""
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialise(both.groupBy("a").agg(F.min("b").alias("m")), "stars")
    least = least.select("a", F.least("a", "m").alias("m"))
    out, moved = _observed(both.join(least, "a").where(F.col("b") > F.col("a")), F.col("m") != F.col("a"))
    out = materialise(out.select(F.col("b").alias("a"), F.col("m").alias("b")), "edges")
    return out, moved.get["moved"]


def _small_star(pairs: DataFrame) -> tuple[DataFrame, int]:
    """Link every smaller neighbour of a node, and the node, to the smallest of them; and how many that moves."""
    least = materialise(pairs.groupBy("a").agg(F.min("b").alias("m")), "stars")
    rows, moved = _observed(pairs.join(least, "a"), F.col("b") != F.col("m"))
    out = rows.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    out = materialise(out.unionByName(least.select("a", F.col("m").alias("b"))), "edges")
    return out, moved.get["moved"]
