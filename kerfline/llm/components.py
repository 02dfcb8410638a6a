"""Connected components of a link table, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links(x, y): label is the least node of its component.

    Each round takes the least label among a node and its neighbours, then the label of
    that label, until nothing changes: about log(longest path) rounds. A round is cut to
    the shared folder. An empty table gives no rows.
    """
    both = blocks.cut(links.select(F.col("x").alias("node"), F.col("y").alias("to")).union(links.select("y", "x")).distinct())
    labels = both.groupBy("node").agg(F.least(F.col("node"), F.min("to")).alias("label"))
    while True:
        near = both.join(labels.select(F.col("node").alias("to"), "label"), "to").groupBy("node").agg(F.min("label").alias("least"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "least").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = blocks.cut(step.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")))
        labels = step.select("node", "label")
        if step.where("old <> label").limit(1).count() == 0:
            return labels
