"""Connected components of an edge table, as rounds of DataFrame joins.

Each round points every node at its smallest neighbour, follows the pointers to their ends by doubling, and
moves the edges to those ends; edges within one end vanish.  Rounds and doublings go on until nothing is
left to do; every step is staged, so a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.sources.staging import stage


def _roots(parents: DataFrame) -> DataFrame:
    """(node, root) from (node, root) pointers that always lead to a smaller node."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        jumped = stage(
            parents.join(up, "root", "left").select("node", F.coalesce("_up", "root").alias("root"), (F.col("_up") < F.col("root")).alias("_moved"))
        )
        moved = not jumped.where("_moved").isEmpty()
        parents = jumped.select("node", "root")
        if not moved:
            return parents


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of an edge (a, b) the smallest node it is connected to."""
    open_edges = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    total = None
    while not open_edges.isEmpty():
        both = open_edges.unionByName(open_edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m"))
        roots = _roots(stage(near.select("node", F.least("node", "_m").alias("root"))))
        left = roots.select(F.col("node").alias("a"), F.col("root").alias("_a"))
        right = roots.select(F.col("node").alias("b"), F.col("root").alias("_b"))
        moved = open_edges.join(left, "a").join(right, "b").where("_a <> _b")
        open_edges = stage(moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())
        if total is None:
            total = roots
        else:
            later = roots.select(F.col("node").alias("root"), F.col("root").alias("_end"))
            total = stage(total.join(later, "root", "left").select("node", F.coalesce("_end", "root").alias("root")))
    return total if total is not None else open_edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
