"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import store


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of `edges` (a, b: long) is connected with.

    Each round gives every node the least label of itself, its neighbours and its label's label. The jump over labels
    halves the remaining distances, so the rounds grow with the logarithm of the longest path. A hub's messages are
    reduced to their least before they are shuffled. Every round is a stored table, so a lost executor costs one round.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    both = store(both, "edges")
    labels = store(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels")
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("heard"))
        spread = labels.join(heard, labels["node"] == heard["a"], "left")
        spread = spread.select("node", F.col("component").alias("old"), F.least("component", "heard").alias("near"))
        jump = labels.select(F.col("node").alias("target"), F.col("component").alias("far"))
        moved = spread.join(jump, F.col("near") == F.col("target"), "left").select("node", "old", F.least("near", "far").alias("component"))
        moved = store(moved, "labels")
        labels = moved.select("node", "component")
        if not moved.filter("old <> component").limit(1).take(1):
            return labels
