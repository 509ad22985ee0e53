"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeworks.llm.common import drop_materialized, materialize


def large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours go to its smallest neighbour (itself included)."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
    return both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), least


def small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = materialize(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), least


def settled(edges: DataFrame) -> bool:
    """Whether every node is on the larger side of one edge only, or of none: then those of smaller ones are the components."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where((F.col("up") > 1) | (F.col("up") + F.col("down") > 1)).isEmpty()


def connected_components(edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b): the smallest node that it reaches.

    Each round is joins and grouped minima over written tables; only whether it was the last reaches
    the driver. The rounds grow with the logarithm of the longest path. Repeated and looping edges do
    no harm; an empty table gives an empty one.
    """
    at = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(most_rounds):
        if settled(at):
            break
        stars, least_a = large_star(at)
        middle = materialize(stars, "edges")
        stars, least_b = small_star(middle)
        new = materialize(stars, "edges")
        drop_materialized(at, least_a, middle, least_b)
        at = new
    else:
        raise RuntimeError("components did not settle")
    return at.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")).unionAll(at.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
