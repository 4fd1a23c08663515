"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each end of the edges (a, b): label is the smallest node reachable.

    Alternates the large-star and small-star steps until the edges stand still: every node
    then points at its component's smallest node. Each round is written to the shared
    folder. Minima are summed up before the shuffle; a node with very many edges is a hot
    key of a join, which adaptive execution splits. Self loops are dropped.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if mark == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        before = mark
        edges = stored(_small_star(_large_star(edges)), "edges")


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node move to its smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
