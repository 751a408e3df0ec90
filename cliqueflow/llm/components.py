"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour joins the least of a node's neighbourhood; small star: every smaller one does."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = both.join(low, "u")
    if large:
        out = out.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        hooked = out.select(F.col("v").alias("a"), F.col("m").alias("b"))
        out = hooked.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b): the least node that it reaches.

    Each round is stored in the shared scratch folder; it ends when every edge
    points from a node to the least one of its component.
    """
    spark = edges.sparkSession
    edges, path = materialize(edges.filter(F.col("a") != F.col("b")).distinct(), "edges")
    while True:
        stepped, new_path = materialize(_star(_star(edges, True), False), "edges")
        # done when no node is both hooked and hooked onto, and none is hooked twice
        tails = stepped.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        heads = stepped.select(F.col("b").alias("a")).distinct()
        open_ends = tails.filter("n > 1").select("a").unionByName(heads.join(tails, "a").select("a"))
        done = open_ends.isEmpty()
        drop_path(spark, path)
        edges, path = stepped, new_path
        if done:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
