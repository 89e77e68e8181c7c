"""Connected components of links, by smallest label and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm import store


def components(links: DataFrame) -> DataFrame:
    """links: a, b. One row per linked node: node, label (the smallest node of its component).

    A round takes the smallest label among a node's neighbours, then the label
    of that label, so the rounds grow with the logarithm of the longest path.
    Each round is a table of its own in the shared folder. Neighbours are
    combined before the shuffle, so a node with many links is one row a task.
    """
    both = store.written(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links"
    )
    labels = store.written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select(
            "node", F.least("node", "label").alias("label")
        ),
        "labels",
    )
    while True:
        near = (
            both.withColumnRenamed("b", "node")
            .join(labels, "node")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        nearest = labels.join(near, "node").select(
            "node", "label", F.least("label", "near").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("jumped"))
        moved = store.written(
            nearest.join(jump, "next").select(
                "node", F.col("jumped").alias("label"), (F.col("jumped") != F.col("label")).alias("new")
            ),
            "labels",
        )
        labels = moved.select("node", "label")
        if not moved.where("new").limit(1).count():
            return labels
