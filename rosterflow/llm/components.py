"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b), both longs; the label is the smallest node that can be reached.

    Each round gives a node the smallest label among its neighbours and then the label of that
    label, so that the number of rounds grows with the logarithm of the longest path. Labels are
    checkpointed after each round. Minima are combined before the shuffle, and joins on a hub are
    split by adaptive execution.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = saved(both.filter("a <> b").distinct())
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        moved = saved(
            lower.join(above, "label", "left").select("node", "was", F.least("label", F.coalesce("jump", "label")).alias("label"))
        )
        changed = moved.filter("was <> label").limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels
