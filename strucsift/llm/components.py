"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strucsift.session import cut_lineage

# Contraction needs a number of rounds logarithmic in the number of vertices.
MOST_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex is linked to the vertex's smallest neighbour or itself."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("n")).unionByName(
        edges.select(F.col("b").alias("v"), F.col("a").alias("n")))
    least = both.groupBy("v").agg(F.least(F.min("n"), F.col("v")).alias("m"))
    return both.filter("n > v").join(least, "v").select(F.col("m").alias("a"), F.col("n").alias("b")).filter("a < b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its neighbours below it are linked to the smallest of them."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    joined = edges.join(least, "b")
    return (
        joined.select(F.col("m").alias("a"), F.col("a").alias("b"))
        .unionByName(least.select(F.col("m").alias("a"), "b")).filter("a < b").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every vertex in ``links`` (a, b): ``root`` is the smallest id it reaches.

    Links are pairs of integer ids in any order; loops and nulls are ignored. Each round is
    written to the shared folder.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges = cut_lineage(edges, "links")
    for _ in range(MOST_ROUNDS):
        edges = cut_lineage(_small_star(_large_star(edges)), "links")
        # Done when all edges are stars: no vertex is both a root and a leaf, and none has two roots.
        leaves = edges.groupBy("b").agg(F.count(F.lit(1)).alias("n"))
        if leaves.filter("n > 1").isEmpty() and edges.select("a").join(leaves.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"components not found in {MOST_ROUNDS} rounds")
    return edges.select(F.col("b").alias("id"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct())
