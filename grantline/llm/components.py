"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.checkpoints import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (
        edges.join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .where("u <> v")
    )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Component of every node that has an edge: columns ``id``, ``component`` (smallest id).

    ``edges`` has two long columns ``u`` and ``v``; loops, repeats and either direction are
    allowed. The number of rounds is logarithmic in the longest path; each is written to
    the shared folder. A node with very many neighbours is pre-aggregated for its minimum
    and joined as skewed rows, never gathered.
    """
    current = written(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(current)
    while mark[0]:
        current = written(_small_star(_large_star(current).distinct()).distinct(), "edges")
        before, mark = mark, _mark(current)
        if before == mark:
            break
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
