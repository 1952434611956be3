"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfmark.llm.common import discard, stored


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than u is linked with the smallest of u and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("x")).agg(F.min(F.least("u", "v")).alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """u and every neighbour not larger than it are linked with the smallest of them. Edges come with u > v."""
    least = edges.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
    moved = edges.join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: u, v (long, u > v, distinct). Returns stored rows u, v for every node u that isn't its component's smallest node v.

    Each round is written to the shared folder, so lineage stays short; the loop ends when a round changes no edge. Nodes
    with many links are only ever aggregated with partial sums and joined with one row per node.
    """
    edges = stored(links.select("u", "v"), "links")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == seen or not state[0]:
            return edges
        seen = state
        new = stored(small_star(large_star(edges)), "links")
        discard(edges)
        edges = new
