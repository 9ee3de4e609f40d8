"""Connected components by alternating stars, with tables written between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riftlog.session import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the smallest of its surroundings.
    The smallest is an aggregate (combined on the map side), written before it is joined
    back: both sides of the join are then plain shuffles, so the rows of a node with very
    many neighbours can be split."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(settle(least, "least"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    least = settle(least, "least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (u, v); a component is named by its
    smallest node. Every round halves the distances; the rounds end when nothing moves."""
    edges = settle(edges.where("u <> v").select("u", "v").distinct(), "edges")
    state = None
    while True:
        edges = settle(_small_star(_large_star(edges)), "edges")
        # Stars of which no edge moves any more have this sum of hashes twice.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
