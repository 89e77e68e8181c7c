"""What every worker is doing, from start and end messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import node_label


def latest_per_worker(messages: DataFrame) -> DataFrame:
    """worker, status, filename, seq of the last message; works on streams too."""
    last = F.max_by(F.struct("status", "filename", "seq"), F.col("seq")).alias("_last")
    return messages.groupBy("worker").agg(last).select("worker", "_last.*")


def active_workers(messages: DataFrame, cores_per_node: int) -> DataFrame:
    """Workers whose last message is a start, with their file and node."""
    return (
        latest_per_worker(messages)
        .where(F.col("status") == "start")
        .select("worker", node_label("worker", cores_per_node).alias("node"), "filename")
    )
