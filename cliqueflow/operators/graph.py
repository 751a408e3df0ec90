"""Folding references into a weighted directed graph (vertices, edges)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalise_references(refs: DataFrame) -> DataFrame:
    """Accept the legacy ``(id, reply_id)`` naming as well as ``(src, dst)``."""
    return refs.withColumnsRenamed({"id": "src", "reply_id": "dst"}).select("src", "dst")


def vertex_ids(refs: DataFrame) -> DataFrame:
    """Distinct non-null ids at either end of a reference (one scan of ``refs``)."""
    refs = normalise_references(refs)
    return (
        refs.select(F.explode(F.array("src", "dst")).alias("id"))
        .filter(F.col("id").isNotNull())
        .distinct()
    )


def initial_vertices(ids: DataFrame) -> DataFrame:
    """Every id starts as its own label, unlocked."""
    return ids.select("id", F.col("id").alias("label"), F.lit(False).alias("prelabelled"))


def check_seeds(seeds: DataFrame) -> None:
    dup = (
        seeds.filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .limit(1)
        .collect()
    )
    if dup:
        raise ValueError(f"seed id {dup[0]['id']!r} is given more than once")


def build_vertices(refs: DataFrame, seeds: DataFrame, validate: bool = True) -> DataFrame:
    """Vertices of the graph: unseeded ids as their own label, plus every seed.

    Seeds appear even when they have no edge. Seed ids are matched with an anti
    join, so the seed list never travels through the driver.
    """
    if validate:
        check_seeds(seeds)
    seeded = seeds.filter(F.col("id").isNotNull()).select(
        "id", "label", F.coalesce(F.col("prelabelled"), F.lit(True)).alias("prelabelled")
    )
    unseeded = initial_vertices(vertex_ids(refs)).join(seeded.select("id"), "id", "left_anti")
    return unseeded.unionByName(seeded)


def build_edges(refs: DataFrame) -> DataFrame:
    """(src, dst, weight): number of references per ordered pair, self-loops and null ends kept."""
    return (
        normalise_references(refs)
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
