"""Connected components of a graph given as an edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborsync.staging import stage


def connected_components(edges: DataFrame, one: str = "a", other: str = "b") -> DataFrame:
    """(node, label) for every node of ``edges``; the label is the smallest node of its component.

    Each round lowers a node's label to the least among its neighbours, hands that on to the node it
    pointed at before, and follows the new label one step further, so that rounds grow with the
    logarithm of the longest path. Loops and repeated edges do no harm; null nodes take no part.
    Every round is written to the shared work folder and only counts come to the driver.
    """
    plain = edges.select(F.col(one).alias("a"), F.col(other).alias("b")).where("a is not null and b is not null")
    both = stage(plain.union(plain.select("b", "a")).distinct(), "edges")
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    labels = stage(first.select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        held = labels.select(F.col("node").alias("b"), "label")
        near = both.join(held, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lowered = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("new"))
        # Written, so that the join with it is a plain one of two tables: adaptive execution can split a giant component.
        handed = stage(lowered.groupBy(F.col("old").alias("new")).agg(F.min("new").alias("handed")), "handed")
        jumped = lowered.join(handed, "new", "left").select(
            "node", "old", F.least("new", F.coalesce("handed", "new")).alias("label")
        )
        moved = stage(jumped, "labels")
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels
