"""Connected components over links, as repeated minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import checkpointed


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links (a, b): root is the smallest node reachable.

    Every round takes the smallest label among a node's neighbours and then the label's
    own label, so labels travel twice as far each round. Nothing is collected but one
    number a round; each round's labels are written to the checkpoint folder."""
    both = checkpointed(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    )
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.first("a"), F.min("b")).alias("root")
    ))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(
            F.min("root").alias("near")
        )
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", "root", F.least("root", "near").alias("low")
        )
        ahead = labels.select(F.col("node").alias("low"), F.col("root").alias("jump"))
        moved = checkpointed(lower.join(ahead, "low").select(
            "node", "jump", (F.col("jump") < F.col("root")).alias("moved")
        ))
        labels = moved.select("node", F.col("jump").alias("root"))
        if not moved.filter("moved").limit(1).count():
            return labels
