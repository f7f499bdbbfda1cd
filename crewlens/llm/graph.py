"""Connected components of links, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crewlens.llm.shared import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.unionByName(least.select("a", F.col("root").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node in `links` (a, b); the root is the least node that links reach.

    Large-star and small-star steps alternate until all edges point at roots. A hub's edges are dealt by its neighbours,
    sums of minima run before each shuffle, and each round's edges are written once: lineage stays short."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while True:
        edges = written(_small_star(_large_star(edges)), name)
        # Done when every node has one root and no root has one of its own.
        many = edges.groupBy("a").count().where("count > 1")
        chained = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        if many.isEmpty() and chained.isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def best_per(df: DataFrame, key: str, *order) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_place", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_place = 1").drop("_place")
