"""Connected components of an edge table by least labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_table


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to node, group: the least node that edges connect a node with.

    Each round every node takes the least label around it, then the label of that label.
    Labels go through minima with a map-side step, so no neighbourhood is gathered.
    """
    both = keep_table(
        edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "graph-edges",
    )
    labels = keep_table(
        both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("group")).withColumnRenamed("a", "node"),
        "graph-labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "group"), "b")
            .groupBy("a")
            .agg(F.min("group").alias("near"))
        )
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("group").alias("old"), F.least("group", "near").alias("new")
        )
        hop = labels.select(F.col("node").alias("at"), F.col("group").alias("hop"))
        moved = keep_table(
            lower.join(hop, F.col("new") == F.col("at")).select(
                "node", "old", F.least("new", "hop").alias("group")
            ),
            "graph-labels",
        )
        labels = moved.select("node", "group")
        if moved.where(F.col("old") != F.col("group")).isEmpty():
            return labels
