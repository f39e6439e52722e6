"""Connected components of an edge table, by rounds of label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pulseframe.sources.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node it is connected to) of every node of ``edges`` (a, b).

    A round gives every node the smallest label around it and then the label of that label, so a chain of n nodes takes
    about log2(n) rounds. Hot nodes are safe: neighbours are folded on the map side before they move. Edges with NULL
    ends are ignored, loops only introduce their node; each round is written to the shared folder.
    """
    both = edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    both = stage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        stepped = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        onward = stepped.select(F.col("node").alias("component"), F.col("component").alias("onward"))
        moved = stage(
            stepped.join(onward, "component", "left").select(
                "node", "before", F.least("component", "onward").alias("component")
            ),
            "labels",
        )
        if moved.where("before <> component").isEmpty():
            return moved.select("node", "component")
        labels = moved.select("node", "component")
