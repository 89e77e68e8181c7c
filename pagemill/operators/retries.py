"""What failed, how often, and when it is tried again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Retry:
    """A file is set apart after `attempts` failures; before that the pause doubles with each one."""

    attempts: int = 5
    first_pause: int = 60  # seconds
    longest_pause: int = 3600


def failure_state(failures: DataFrame, policy: Retry = Retry()) -> DataFrame:
    """basename, attempts, reason (the last), last_at, next_due, set_apart: a row a file.

    failures(basename, reason, counts, at): rows that do not count (a file that was
    not taken for its size) ask for another attempt without being one.
    """
    folded = failures.groupBy("basename").agg(
        F.count_if("counts").alias("attempts"),
        F.max(F.struct("at", "reason")).alias("last"),
    )
    doubled = F.lit(float(policy.first_pause)) * F.pow(F.lit(2.0), F.greatest(F.col("attempts") - 1, F.lit(0)))
    pause = F.least(F.lit(float(policy.longest_pause)), doubled).cast("int")
    return folded.select(
        "basename",
        "attempts",
        F.col("last.reason").alias("reason"),
        F.col("last.at").alias("last_at"),
        F.timestamp_add("SECOND", pause, "last.at").alias("next_due"),
        (F.col("attempts") >= policy.attempts).alias("set_apart"),
    )


def due(state: DataFrame, now: Column, since: Column) -> DataFrame:
    """Files to be tried now: whose pause is over, or that failed before `since`, the start of this run."""
    again = (F.col("next_due") <= now) | (F.col("last_at") < since)
    return state.where(~F.col("set_apart") & again)
