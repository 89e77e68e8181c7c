"""A whole run: fetching and cleaning side by side until nothing is left, state exported on the way."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from pagemill.constants import BASE_URL, SAVE_INTERVAL_SECONDS
from pagemill.operators.retries import Retry
from pagemill.plans.batch import Layout, export_state, recover_ledger, totals
from pagemill.streaming.streams import clean_stream, fetch_stream, retry_stream


def run_to_end(
    spark: SparkSession,
    manifest_folder: str,
    layout: Layout,
    base_url: str = BASE_URL,
    state_folder: str | None = None,
    fetch_options: dict | None = None,
    policy: Retry = Retry(),
    recover: bool = False,
    **clean_options,
) -> DataFrame:
    """Fetch what the manifests list, clean what has landed, export state; one row of totals.

    Cleaning takes what is there, at intervals while copies come in, and once more after the
    last; state goes to `state_folder` (default: under the layout) after each
    round. Then what failed in earlier calls gets one more attempt, copied anew, until
    `policy` sets it apart. `recover` first writes a lost ledger anew from the outputs. Stopped anywhere, the same call goes on from the streams' checkpoints.
    """
    started = datetime.now(timezone.utc)
    if recover:
        recover_ledger(spark, layout)
    state_folder = state_folder or layout.folder("state")
    spark.createDataFrame([], "value STRING").write.mode("ignore").text(layout.landing)
    fetching = fetch_stream(spark, manifest_folder, layout, base_url, **(fetch_options or {}))
    copying = True
    while copying:
        copying = fetching.isActive  # asked before the round, so that a last round sees every copy
        clean_stream(spark, layout, **clean_options).awaitTermination()
        export_state(spark, layout, state_folder)
        if copying:  # raises what ended it, if it did not end well
            fetching.awaitTermination(SAVE_INTERVAL_SECONDS)
    fetching.awaitTermination()
    again = retry_stream(
        spark, manifest_folder, layout, base_url, policy, started,
        fetch_options=fetch_options, **clean_options,
    )
    again.awaitTermination()
    export_state(spark, layout, state_folder)
    return totals(spark, layout)
