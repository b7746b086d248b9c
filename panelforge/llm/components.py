"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.joins import attach
from panelforge.runtime import freeze


def _are_stars(edges: DataFrame) -> bool:
    """Does every node point to one root, and no root anywhere?"""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("points"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("points"), F.lit(1).alias("root"))
    )
    nodes = ends.groupBy("v").agg(F.sum("points").alias("points"), F.max("root").alias("root"))
    return nodes.where("points + root > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """Columns node and root (the smallest node of its component) for every node of ``edges`` (a, b).

    Large-star and small-star rounds: every node points its larger neighbours, then its smaller
    ones, to the smallest node it knows, until each component is one star. The rounds grow with the
    logarithm of a component's size; neighbours are never gathered, only their minimum is
    (with partial minima) and attached again, so a node with a third of all edges is split.
    Each round is a written table. Self-loops and repeated edges are ignored.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = freeze(edges.where("a <> b").select(high.alias("a"), low.alias("b")).distinct())
    while not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = freeze(
            attach(both, least, ["a"], "inner").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = freeze(
            attach(large, smallest, ["a"], "inner")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(smallest.select("a", F.col("m").alias("b")))
            .distinct()
        )
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
