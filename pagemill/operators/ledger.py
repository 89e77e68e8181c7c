"""The record of what is done, as append-only rows folded on read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pagemill.functions.text import as_elapsed, as_gigabytes

SEQ_SPAN = 4096


def lookup(
    keys: DataFrame, ledger: DataFrame, key: str, default: Mapping[str, object]
) -> DataFrame:
    """keys + the ledger's values for them; absent keys and NULLs get the defaults."""
    joined = keys.join(ledger.select(key, *default), key, "left")
    return joined.select(
        *keys.columns, *(F.coalesce(c, F.lit(v)).alias(c) for c, v in default.items())
    )


def add_deltas(current: DataFrame, deltas: DataFrame, key: str, counters: list[str]) -> DataFrame:
    """Counters after adding the deltas; an absent counter counts as zero."""
    return fold(
        current.select(key, *counters).unionByName(deltas.select(key, *counters)),
        key,
        {c: F.coalesce(F.sum(c), F.lit(0)) for c in counters},
    )


def set_latest(changes: DataFrame, key: str, seq: str, values: list[str]) -> DataFrame:
    """The value of the last change per key."""
    return fold(changes, key, {v: F.max_by(v, seq) for v in values})


def fold(changes: DataFrame, key: str, merge: Mapping[str, Column]) -> DataFrame:
    """General update: one aggregate expression per value, partially applied before the shuffle."""
    return changes.groupBy(key).agg(*(c.alias(name) for name, c in merge.items()))


def insert_absent(ledger: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows to append: one per new key that the ledger does not have.

    Of several new rows with a key the smallest is taken, so that the choice
    does not depend on timing.
    """
    values = [c for c in new.columns if c != key]
    row = F.min(F.struct(*values)) if values else F.count(F.lit(1))
    rows = new.groupBy(key).agg(row.alias("_row"))
    rows = rows.select(key, "_row.*") if values else rows.select(key)
    return rows.join(ledger.select(key), key, "left_anti").select(*new.columns)


def without_removed(changes: DataFrame, key: str, seq: str, removes: Column) -> DataFrame:
    """Keys whose last change is not a removal."""
    last = F.max_by(removes, F.col(seq))
    return changes.groupBy(key).agg(last.alias("_removed")).where(~F.col("_removed")).select(key)


def distinct_names(*tables: DataFrame, name: str = "basename") -> DataFrame:
    """Every name once, in ascending order."""
    union = tables[0].select(name)
    for other in tables[1:]:
        union = union.unionByName(other.select(name))
    return union.distinct().orderBy(name)


def downloads_in_effect(
    events: DataFrame,
    key: str,
    seq: str,
    amount: str,
    downloaded: Column,
    reverted: Column,
    span: int = SEQ_SPAN,
) -> DataFrame:
    """Per key, the amount of the first download after the last revert.

    Later repeats of a download do not count. Events of a key are folded in
    runs of `span` consecutive sequence numbers first, so a key with very many
    events is worked on by many tasks.
    """
    run = F.expr(f"`{seq}` div {span}")
    marked = events.select(
        F.col(key),
        run.alias("_run"),
        F.col(seq).alias("_seq"),
        F.col(amount).alias("_amount"),
        downloaded.alias("_down"),
        reverted.alias("_back"),
    ).where("_down OR _back")
    within = W.partitionBy(key, "_run")
    last_back = F.max(F.when(F.col("_back"), F.col("_seq"))).over(within)
    counts = F.col("_down") & (F.col("_seq") > F.coalesce("_last_back", F.lit(-1)))
    runs = (
        marked.withColumn("_last_back", last_back)
        .groupBy(key, "_run")
        .agg(F.min_by(F.struct("_seq", "_amount"), F.when(counts, F.col("_seq"))).alias("_first"))
    )
    # A run counts when no later run holds a revert; its own reverts are accounted
    # for. Taken from the events again, so that their rows are shuffled once only.
    last_run = marked.where("_back").groupBy(key).agg(F.max("_run").alias("_from"))
    return (
        runs.where("_first IS NOT NULL")
        .join(last_run, key, "left")
        .where(F.col("_from").isNull() | (F.col("_run") >= F.col("_from")))
        .groupBy(key)
        .agg(F.min_by("_first._amount", "_first._seq").alias(amount))
    )


def run_totals(downloads: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row of totals; every basename counts once on either side, with its first event.

    downloads(basename, bytes, at), cleaned(basename, removed_bytes, at).
    """
    down = downloads.groupBy("basename").agg(
        F.min_by("bytes", F.struct("at", "bytes")).alias("bytes"), F.min("at").alias("first_at"), F.max("at").alias("last_at")
    )
    done = cleaned.groupBy("basename").agg(
        F.min_by("removed_bytes", F.struct("at", "removed_bytes")).alias("removed"),
        F.min("at").alias("first_at"),
        F.max("at").alias("last_at"),
    )
    zero = F.lit(0).cast("bigint")
    both = down.select(
        "bytes", zero.alias("removed"), F.lit(1).alias("d"), F.lit(0).alias("c"), "first_at", "last_at"
    ).unionByName(
        done.select(
            zero.alias("bytes"), "removed", F.lit(0).alias("d"), F.lit(1).alias("c"), "first_at", "last_at"
        )
    )
    return both.agg(
        F.coalesce(F.sum("bytes"), zero).alias("total_data_downloaded_bytes"),
        F.coalesce(F.sum("removed"), zero).alias("total_data_removed_bytes"),
        F.coalesce(F.sum("d"), zero).alias("total_warc_processed_for_download_count"),
        F.coalesce(F.sum("c"), zero).alias("total_warc_successfully_cleaned_count"),
        F.min("first_at").alias("start_time"),
        F.max("last_at").alias("last_update"),
    )


def run_summary(totals: DataFrame, now: Column) -> DataFrame:
    """(metric, value) rows of one row of totals; `now` is given, so results repeat."""
    elapsed = F.unix_timestamp(now) - F.unix_timestamp("start_time")
    shown = totals.select(
        as_elapsed(F.coalesce(elapsed, F.lit(0))).alias("Elapsed Time"),
        as_gigabytes("total_data_downloaded_bytes").alias("Data Downloaded"),
        as_gigabytes("total_data_removed_bytes").alias("Data Removed (Est.)"),
        F.col("total_warc_processed_for_download_count").cast("string").alias("WARCs Downloaded"),
        F.col("total_warc_successfully_cleaned_count").cast("string").alias("WARCs Cleaned"),
    )
    return shown.unpivot([], [f"`{c}`" for c in shown.columns], "metric", "value")
