"""Connected components by alternating star contraction, with the lineage cut after each round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arriero.sinks.tables import written

MAX_ROUNDS = 60


def _star(edges: DataFrame, downward: bool) -> DataFrame:
    """One half round. Each node's least neighbour is a map-side combined minimum, joined back to the edges (AQE splits hot nodes).

    Upward (large star): neighbours above a node move to its least neighbour or itself. Downward (small star): neighbours below it, and itself, do.
    """
    if downward:
        ends = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        ends = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = ends.join(least, "u")
    moved = joined.where("v > u" if not downward else "v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if downward:
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.where("u != v")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v): the component is its least node. Null ends and loops are left out.

    An empty edge table gives an empty result.
    """
    edges = written(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        edges = written(_star(_star(edges, False), True).distinct(), "edges")
        n, nodes = edges.agg(F.count("*"), F.count_distinct("u")).first()
        roots = edges.select(F.col("v").alias("u")).distinct()
        if n == nodes and not edges.join(roots, "u", "left_semi").limit(1).count():  # every node hangs on a root: stars only
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select(F.col("u").alias("node"), F.col("u").alias("component")))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
