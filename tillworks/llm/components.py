"""Connected components of an edge table, on Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node that an edge (a, b) names.

    Each round joins every node with the least root among its neighbours and lets roots follow their own roots, so
    chains shorten by half or better. Labels are written to the shared folder after every round, which ends the
    lineage there; the driver sees only the count of changes. The least neighbour is an aggregate, so a node with many
    edges sends one row per task.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        # A root that finds a lower one takes all that point to it along.
        hooked = lower.groupBy(F.col("root").alias("was")).agg(F.min("next").alias("becomes"))
        moved = lower.join(hooked, lower["root"] == hooked["was"], "left").select(
            "node", F.col("root").alias("before"), F.least("next", "becomes").alias("root")
        )
        after = written(moved, "labels")
        if not after.filter(F.col("root") != F.col("before")).limit(1).count():
            return after.select("node", "root")
        labels = after.select("node", "root")
