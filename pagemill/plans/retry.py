"""Another attempt for what failed: copies that did not come, archives that could not be cleaned.

What is pending follows from the tables alone (failures, fetch log, ledger, listing
of the landing folder), so it does not matter which files a stream has seen.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.constants import BASE_URL
from pagemill.operators.manifest import skip_cleaned
from pagemill.operators.retries import Retry, due, failure_state
from pagemill.plans import batch as plan
from pagemill.plans.batch import Layout
from pagemill.sources.warc import archive_listing


def failures(spark: SparkSession, layout: Layout) -> DataFrame:
    """basename, reason, counts, at: every failed copy and every failed cleaning."""
    log = plan.read_table(spark, layout.fetch_log, plan.FETCH_LOG_DDL)
    copies = log.where(F.col("status").isin(*plan.FAILED_COPIES, *plan.NOT_TAKEN)).select(
        "basename",
        F.coalesce("error", "status").alias("reason"),
        F.col("status").isin(*plan.FAILED_COPIES).alias("counts"),
        "at",
    )
    cleaned = plan.read_table(spark, layout.failures, plan.FAILURES_DDL)
    return copies.unionByName(cleaned.select("basename", "reason", F.lit(True).alias("counts"), "at"))


def retry_table(spark: SparkSession, layout: Layout, policy: Retry = Retry()) -> DataFrame:
    """The state of every file that failed and is not done: see `failure_state`."""
    ledger = plan.read_table(spark, layout.ledger, plan.LEDGER_DDL)
    return skip_cleaned(failure_state(failures(spark, layout), policy), ledger)


def run_retries(
    spark: SparkSession,
    manifest: DataFrame,
    layout: Layout,
    since: Column,
    policy: Retry = Retry(),
    base_url: str = BASE_URL,
    batch: str | None = None,
    run: str | None = None,
    now: Column | None = None,
    fetch_options: dict | None = None,
    **clean_options,
) -> dict[str, int]:
    """One attempt for every file that is due; returns the counters of the batch.

    Files that the manifest(rel_path, basename) lists are copied anew, as a bad archive may
    be a bad copy; what lies in the landing folder and no manifest lists is read again as it is.
    `since` is the start of this run: what failed before it is due at once.
    """
    batch = batch or uuid.uuid4().hex
    now = F.current_timestamp() if now is None else now
    names = plan._materialize(
        due(retry_table(spark, layout, policy), now, since).select("basename"),
        f"{layout.staging(spark, run or batch)}/due",
    )
    if names.isEmpty():
        return {"records": 0, "text_bytes": 0, "errors": 0}
    listed = manifest.join(names, "basename", "left_semi")
    copied = plan.run_fetch(
        spark, listed, layout, batch=batch, base_url=base_url, run=run, **(fetch_options or {})
    )
    absent = copied.where("status NOT IN ('downloaded', 'skipped_cleaned')").select("basename")
    landed = archive_listing(spark, layout.landing)
    pending = landed.join(names, "basename", "left_semi").join(absent, "basename", "left_anti")
    return plan.run_batch(spark, pending, layout, batch=batch, run=run, **clean_options)
