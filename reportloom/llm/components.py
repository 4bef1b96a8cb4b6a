"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum (with map-side partial results) and a join of two written tables, whose skewed keys
Spark splits at run time, so the centre of a large component is never gathered in one task. Only linked nodes take
part. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm.storage import checksum, stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b), longs, any order, repeats and self-links allowed -> (node, root), root = smallest node.

    Nodes without a link to another node do not appear. No edges give an empty table.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                 "edges")
    before = None
    while (state := checksum(now, "u", "v")) != before:
        before = state
        now = _small_star(_large_star(now))
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def _with_least(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node's neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return stored(linked.distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    met = _with_least(edges)
    links = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(met.select("u", F.col("m").alias("v")))
    return stored(links.where("u > v").distinct(), "small-star")
