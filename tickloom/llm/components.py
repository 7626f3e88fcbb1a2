"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import store


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; component is the smallest node reachable.

    `edges` has long columns a and b. Every round gives each node the smallest label among its
    neighbours, then replaces labels by their own labels, so the rounds grow with the logarithm
    of a path's length. Neighbours are reduced before each shuffle, so a node with very many of
    them is one row per task. Rounds are stored in the shared folder: a lost executor costs its
    tasks, not the rounds before.
    """
    both = store(
        edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges"
    )
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("best"))
        of_label = labels.select(F.col("node").alias("best"), F.col("label").alias("further"))
        new = store(
            lower.join(of_label, "best", "left").select(
                "node",
                F.least("best", F.coalesce("further", "best")).alias("new_label"),
                "label",
            ),
            "labels",
        )
        changed = new.where("new_label <> label").limit(1).count()
        labels = new.select("node", F.col("new_label").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")
