"""Connected components of a graph of long node ids, by hooking to the least neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.session import sized, stored

# Pointers that may be sent to all tasks; more are sorted and merged. Labels repeat, so files of many of them are small.
BROADCAST_NODES = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); nodes have the same label if a path joins them.

    Null ends and loops are ignored, repeated edges do not matter, no edges give no rows. Every round points each node
    at its least neighbour, follows the pointers to their roots and goes on with the edges between different roots.
    Each node's pointer and each edge is a row: no node's neighbours are gathered.
    """
    rest = stored(ordered(edges), "cc-edges")
    labels: DataFrame | None = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
        up = rooted(stored(up, "cc-up"))
        if labels is None:
            labels = up
        else:
            further = up.select(F.col("node").alias("label"), F.col("label").alias("_root"))
            labels = labels.join(sized(further, BROADCAST_NODES), "label", "left")
            labels = stored(labels.select("node", F.coalesce("_root", "label").alias("label")), "cc-labels")
        ends = rest.join(sized(up.select(F.col("node").alias("a"), F.col("label").alias("_a")), BROADCAST_NODES), "a")
        ends = ends.join(sized(up.select(F.col("node").alias("b"), F.col("label").alias("_b")), BROADCAST_NODES), "b")
        rest = stored(ordered(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b"))), "cc-edges")
    return labels if labels is not None else edges.sparkSession.createDataFrame([], "node long, label long")


def ordered(edges: DataFrame) -> DataFrame:
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b").select(low, high).distinct()


def rooted(up: DataFrame) -> DataFrame:
    """Pointers that only lead to smaller nodes, followed to their ends; the distance halves in each step."""
    while True:
        above = up.select(F.col("node").alias("label"), F.col("label").alias("_above"))
        higher = F.coalesce("_above", "label")
        step = up.join(sized(above, BROADCAST_NODES), "label", "left").select("node", higher.alias("label"), (higher != F.col("label")).alias("_moved"))
        step = stored(step, "cc-up")
        moved = step.where("_moved").limit(1).count()
        up = step.drop("_moved")
        if not moved:
            return up
