"""One batch from archives to corpus and ledger, and the state derived from it.

Order of effects: staged records, corpus, ledger. A batch writes to folders of
its own for every attempt, and only what the ledger names is read: batch and
attempt of each archive. A batch that dies half-way leaves no ledger rows; done again under the
same name it leaves out what the ledger has of it, and never touches what an earlier attempt wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagemill.constants import BASE_URL, MIN_TEXT_LENGTH, STATS_COUNTERS, STATS_NAMES, STATS_TIMES
from pagemill.functions.text import basename, drop_output_suffix, to_iso
from pagemill.operators import corpus as corpus_ops
from pagemill.operators import ledger as ledger_ops
from pagemill.operators import manifest as manifest_ops
from pagemill.operators.records import extract_pages
from pagemill.session import PAGE_BATCHES, settings, shared_dir
from pagemill.sources.fetch import FETCH_DDL, fetch, lookup_sizes
from pagemill.sources.state_json import name_documents, write_state_json
from pagemill.sources.warc import SPLIT_BYTES, broken_splits, scan_archives, scan_size

LEDGER_DDL = (
    "basename STRING, input_bytes BIGINT, kept_records BIGINT, output_bytes BIGINT, "
    "removed_bytes BIGINT, at TIMESTAMP, attempt STRING, batch STRING"
)
FETCH_LOG_DDL = FETCH_DDL + ", at TIMESTAMP, batch STRING"
FAILURES_DDL = "basename STRING, reason STRING, at TIMESTAMP, batch STRING"
COUNTERS = (
    "downloaded_bytes", "downloaded_files", "recopied_files", "removed_bytes", "cleaned_files", "records", "text_bytes", "failed_files",
)
COUNTERS_DDL = "".join(f"{c} BIGINT, " for c in COUNTERS) + "at TIMESTAMP, attempt STRING, batch STRING"
FAILED_COPIES = ("head_failed", "failed")
NOT_TAKEN = ("size_zero", "no_capacity")
COPIES = "copies"  # the attempt under which a batch of copies counts
FILES_PER_TASK = 4  # archives that a task copies: what a lost task costs
_STAGED_COLUMNS = (
    "path", "basename", "rec_offset", "rec_number", "at", "next_offset", "kind", "error", "payload",
)


@dataclass(frozen=True)
class Layout:
    """Folders of a run, all under one root that the executors share."""

    root: str

    def folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def landing(self) -> str:
        return self.folder("archives")

    @property
    def corpus(self) -> str:
        return self.folder("corpus")

    @property
    def ledger(self) -> str:
        return self.folder("ledger")

    @property
    def fetch_log(self) -> str:
        return self.folder("fetch_log")

    @property
    def failures(self) -> str:
        """Archives that could not be cleaned; copies that failed are in the fetch log."""
        return self.folder("failures")

    @property
    def counters(self) -> str:
        """A row a batch: what it did, taken from the plans while they ran."""
        return self.folder("counters")

    def staging(self, spark: SparkSession, run: str) -> str:
        """Intermediate tables of a run; the next batch of the run replaces them."""
        shared = shared_dir(spark)
        if not shared:
            return self.folder(f"staging/{run}")
        return f"{shared}/pagemill-{uuid.uuid5(uuid.NAMESPACE_URL, self.root).hex}/{run}"


def read_table(spark: SparkSession, folder: str, ddl: str) -> DataFrame:
    """A batch table of this run; it comes into being, empty, on first use."""
    empty = spark.createDataFrame([], ddl)
    empty.write.mode("ignore").partitionBy("batch").parquet(folder)
    return spark.read.schema(ddl).parquet(folder)


def _materialize(table: DataFrame, folder: str) -> DataFrame:
    # without replacing single partitions: whatever was there before goes
    writer = table.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.option("compression", "zstd").parquet(folder)
    return table.sparkSession.read.schema(table.schema).parquet(folder)


def _append_batch(table: DataFrame, folder: str, batch: str) -> None:
    """Write a batch's rows; writing the same batch again replaces them."""
    (
        table.withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(folder)
    )


def ledger_rows(spark: SparkSession, layout: Layout) -> DataFrame:
    """The ledger, one row per basename: of batches that ran at once the first one counts."""
    rows = read_table(spark, layout.ledger, LEDGER_DDL)
    others = [c for c in rows.columns if c != "basename"]
    first = F.min_by(F.struct(*others), F.struct("at", "batch", F.coalesce("attempt", F.lit(""))))
    return rows.groupBy("basename").agg(first.alias("r")).select("basename", "r.*")


def _fixed(spark: SparkSession, at: Column | None) -> Column:
    """One point in time for all that a batch writes."""
    at = F.current_timestamp() if at is None else at
    return F.timestamp_micros(F.lit(spark.range(1).select(F.unix_micros(at)).first()[0]))


def _counter_row(spark: SparkSession, attempt: str, at: Column, counters: dict[str, int]) -> DataFrame:
    row = spark.createDataFrame(
        [[counters.get(c) or 0 for c in COUNTERS]], ", ".join(f"{c} BIGINT" for c in COUNTERS)
    )
    return row.coalesce(1).withColumns({"at": at, "attempt": F.lit(attempt)})


def _append(table: DataFrame, folder: str) -> None:
    """Add rows, which say their batch; those that are there stay."""
    table.write.mode("append").partitionBy("batch").parquet(folder)


def corpus_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """basename, length over all chunks, batch, attempt; of several outputs the longest."""
    try:
        files = corpus_ops.list_outputs(spark, folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame(
            [], "basename STRING, length BIGINT, batch STRING, attempt STRING"
        )

    def folder_value(name: str) -> Column:
        value = F.regexp_extract("path", f"/{name}=([^/]+)/", 1)
        return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))).alias(name)

    keys = ["basename", "batch", "attempt"]
    sums = (
        files.select(*map(folder_value, keys), "length").groupBy(*keys).agg(F.sum("length").alias("length"))
    )
    best = F.max(F.struct("length", "batch", "attempt")).alias("o")
    return sums.groupBy("basename").agg(best).select("basename", "o.length", "o.batch", "o.attempt")


def run_fetch(
    spark: SparkSession,
    manifest: DataFrame,
    layout: Layout,
    batch: str | None = None,
    base_url: str = BASE_URL,
    listing: DataFrame | None = None,
    budget_bytes: int | None = None,
    tasks: int | None = None,
    at: Column | None = None,
    run: str | None = None,
) -> DataFrame:
    """Manifest(rel_path, basename) -> outcome per basename, logged in the fetch log.

    Outcomes: skipped_cleaned, head_failed, size_zero, no_capacity, failed,
    downloaded. Sizes come from `listing`(basename, content_length) where one is
    given, otherwise each file is asked for its size.
    """
    batch = batch or uuid.uuid4().hex
    staging = layout.staging(spark, run or batch)
    at = _fixed(spark, at)
    tasks = tasks or max(
        spark.sparkContext.defaultParallelism, manifest.count() // FILES_PER_TASK
    )
    ledger = (
        read_table(spark, layout.ledger, LEDGER_DDL)
        .select("basename", F.lit(True).alias("cleaned"))
        .distinct()
    )
    log = read_table(spark, layout.fetch_log, FETCH_LOG_DDL)
    earlier = (
        log.where((F.col("status") == "downloaded") & (F.col("batch") != batch))
        .select("basename", F.lit(True).alias("again"))
        .distinct()
    )
    plan = (
        manifest_ops.one_path_per_basename(manifest)
        .withColumn("url", F.concat(F.lit(base_url), "rel_path"))
        .join(ledger, "basename", "left")
        .join(earlier, "basename", "left")
        .select("basename", "url", "cleaned", F.coalesce("again", F.lit(False)).alias("again"))
    )
    if listing is None:
        # sizes are asked for only where the ledger does not settle the matter
        plan = _materialize(plan, f"{staging}/listed")
        listing = lookup_sizes(plan.where("cleaned IS NULL"), tasks)
    size_status = manifest_ops.size_status("content_length", budget_bytes, F.col("found"))
    plan = manifest_ops.with_sizes(plan, listing).select(
        "basename",
        "url",
        F.when(F.col("cleaned"), F.lit("skipped_cleaned")).otherwise(size_status).alias("status"),
        "again",
    )
    plan = _materialize(plan, f"{staging}/wanted")
    wanted = plan.where("status IS NULL AND NOT again")
    anew = plan.where("status IS NULL AND again")
    skipped = plan.where("status IS NOT NULL").selectExpr(
        "basename", "url", "CAST(NULL AS STRING) AS path", "CAST(NULL AS BIGINT) AS bytes",
        "status", "CAST(NULL AS STRING) AS error",
    )
    counted = Observation("copies")
    came = F.col("status") == "downloaded"
    outcome = fetch(wanted, layout.landing, tasks).observe(
        counted,
        F.sum(F.when(came, F.col("bytes"))).alias("downloaded_bytes"),
        F.count_if(came).alias("downloaded_files"),
    )
    outcome = outcome.unionByName(skipped)
    counts = [counted]
    if not anew.isEmpty():  # copied before: only the first copy of a file counts as a download
        counts.append(Observation("more copies"))
        more = fetch(anew, layout.landing, tasks)
        outcome = outcome.unionByName(more.observe(counts[1], F.count_if(came).alias("recopied_files")))
    _append_batch(outcome.withColumn("at", at), layout.fetch_log, batch)
    seen = {name: n for c in counts for name, n in c.get.items()}
    _append_batch(_counter_row(spark, COPIES, at, seen), layout.counters, f"{COPIES}-{batch}")
    return read_table(spark, layout.fetch_log, FETCH_LOG_DDL).where(F.col("batch") == batch)


def run_batch(
    spark: SparkSession,
    files: DataFrame,
    layout: Layout,
    batch: str | None = None,
    min_len: int = MIN_TEXT_LENGTH,
    split_bytes: int = SPLIT_BYTES,
    span: int = corpus_ops.CHUNK_SPAN,
    extractor: Callable[[Column], Column] | None = None,
    at: Column | None = None,
    skip_existing_outputs: bool = False,
    run: str | None = None,
) -> dict[str, int]:
    """Clean files(path, length): corpus and ledger rows of the batch; returns its counters.

    To be able to repeat an interrupted batch, give it a name in `batch`.
    Batches of a `run` follow one another and use the same staging folder.

    `skip_existing_outputs` also takes archives as done whose output is there
    but not in the ledger. It is for a lost ledger: after an interrupted batch
    an output may be incomplete, which only the ledger can tell.
    """
    batch = batch or uuid.uuid4().hex
    staging = layout.staging(spark, run or batch)
    at = _fixed(spark, at)
    listed = (
        files.select(basename("path").alias("basename"), "path", "length")
        .groupBy("basename")
        .agg(F.min(F.struct("path", "length")).alias("f"))
        .select("basename", "f.path", "f.length")
    )
    attempt = uuid.uuid4().hex
    ledger = read_table(spark, layout.ledger, LEDGER_DDL)
    pending = manifest_ops.skip_cleaned(listed, ledger)
    done = None
    if skip_existing_outputs:
        pending = _materialize(pending, f"{staging}/pending")
        outputs = corpus_outputs(spark, layout.corpus)
        done = corpus_ops.finished_outputs(pending, outputs, min_len).join(
            outputs.select("basename", "batch", "attempt"), "basename"
        )
        todo = pending.join(done.select("basename"), "basename", "left_anti")
    else:
        todo = pending
    todo = _materialize(todo, f"{staging}/todo")
    size = scan_size(todo, split_bytes)
    staged = _stage(todo, f"{staging}/records", size.tasks, split_bytes, min_len, extractor)
    if size.ranges > size.files:
        staged = _reread(todo, staged, staging, split_bytes, min_len, extractor)

    # one row per archive, summed on the map side: what it kept and what went wrong
    bad = (F.col("kind") == "error") | (F.coalesce("route", F.lit("")) == "error")
    fine = F.col("errors") == 0
    seen = Observation("archives")
    status = _materialize(
        corpus_ops.file_metrics(todo, staged, F.col("kind") == "record", bad).observe(
            seen,
            F.sum(F.when(fine, F.col("kept_records"))).alias("records"),
            F.sum(F.when(fine, F.col("output_bytes"))).alias("text_bytes"),
            F.sum(F.when(fine, F.col("removed_bytes"))).alias("removed_bytes"),
            F.count_if(fine).alias("cleaned_files"),
            F.count_if(~fine).alias("failed_files"),
        ),
        f"{staging}/status",
    )
    metrics = {k: v or 0 for k, v in seen.get.items()}
    failed = status.where("errors > 0").select("basename")
    clean = (
        staged.where("kind = 'record'")
        .select("basename", "rec_offset", "rec_number", "at", "text")
        .join(failed, "basename", "left_anti")
    )
    counted = {
        "records": metrics.get("records", 0),
        "text_bytes": metrics.get("text_bytes", 0),
        "errors": metrics.get("failed_files", 0),
    }
    if counted["errors"]:
        why = staged.where(bad).groupBy("basename").agg(F.min("error").alias("reason"))
        unread = F.coalesce("reason", F.lit("a page could not be extracted"))
        rows = failed.join(why, "basename", "left").select("basename", unread.alias("reason"), at.alias("at"))
        _append_batch(rows, layout.failures, batch)
    output = f"{layout.corpus}/batch={batch}/attempt={attempt}"
    if counted["records"]:
        corpus_ops.write_corpus(clean, output, span, counted["text_bytes"], mode="static")
    rows = (
        status.where(fine)
        .drop("errors")
        .withColumns({"at": at, "attempt": F.lit(attempt), "batch": F.lit(batch)})
    )
    if done is not None:
        # the output was there already: recorded as cleaned, with nothing removed
        metrics["cleaned_files"] = metrics.get("cleaned_files", 0) + done.count()
        rows = rows.unionByName(_done_rows(done, at))
    # counted before the ledger, which says whether the attempt counts
    row = _counter_row(spark, attempt, at, metrics)
    _append(row.withColumn("batch", F.lit(batch)), layout.counters)
    _append(rows, layout.ledger)
    return counted


def _reread(
    files: DataFrame,
    staged: DataFrame,
    staging: str,
    split_bytes: int,
    min_len: int,
    extractor: Callable[[Column], Column] | None,
) -> DataFrame:
    """Staged rows in which split archives that did not work out are read in one piece."""
    suspects = (
        broken_splits(staged)
        .unionByName(staged.where("kind = 'error' AND error <> 'missing'").select("path"))
        .distinct()
    )
    again = _materialize(
        files.where(F.col("length") > split_bytes).join(suspects, "path", "left_semi"),
        f"{staging}/again",
    )
    n_again = again.count()
    if not n_again:
        return staged
    whole = _stage(again, f"{staging}/whole", n_again, None, min_len, extractor)
    return staged.join(again.select("path"), "path", "left_anti").unionByName(whole)


def _stage(
    files: DataFrame,
    folder: str,
    tasks: int,
    split_bytes: int | None,
    min_len: int,
    extractor: Callable[[Column], Column] | None,
) -> DataFrame:
    """Read, extract and keep: the one pass over the archives, written once and used thrice."""
    scan = scan_archives(files, tasks, split_bytes=split_bytes).select(*_STAGED_COLUMNS)
    kept = extract_pages(scan, "payload", min_len, extractor).where(
        (F.col("kind") != "record") | (F.col("route") == "error") | (F.length("text") >= min_len)
    )
    with settings(files.sparkSession, PAGE_BATCHES):
        return _materialize(kept, folder)


def clean_corpus(spark: SparkSession, layout: Layout) -> DataFrame:
    """Corpus rows of the archives that the ledger says are done and did not come out empty."""
    place = ["basename", "batch", "attempt"]
    named = ledger_rows(spark, layout).where("kept_records IS NULL OR kept_records > 0").select(*place)
    if named.isEmpty():  # then there may be no corpus to read
        return spark.createDataFrame([], "basename STRING, chunk BIGINT, value STRING")
    rows = corpus_ops.read_corpus(spark, layout.corpus, "batch", "attempt")
    return rows.join(named, place, "left_semi").select("basename", "chunk", "value")


def rebuild_ledger(outputs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Names of existing outputs(path), without their suffix, joined with the known names."""
    found = outputs.select(drop_output_suffix(basename("path")).alias("basename"))
    return ledger_ops.distinct_names(found, *([known] if known is not None else []))


def batch_counters(spark: SparkSession, layout: Layout) -> DataFrame:
    """The counters of every batch of copies and of every attempt that the ledger has rows of."""
    rows = read_table(spark, layout.counters, COUNTERS_DDL)
    attempts = read_table(spark, layout.ledger, LEDGER_DDL).select("batch", "attempt").distinct()
    copies = rows.where(F.col("attempt") == COPIES)
    return rows.join(attempts, ["batch", "attempt"], "left_semi").unionByName(copies)


def totals_of_batches(spark: SparkSession, layout: Layout) -> DataFrame:
    """What `totals` returns, from a row a batch instead of a row an archive.

    The two differ only if batches at once cleaned the same archive: each of them is counted here.
    """
    rows = batch_counters(spark, layout)
    worked = F.greatest("downloaded_files", "recopied_files", "cleaned_files") > 0
    zero = F.lit(0).cast("bigint")
    names = ("downloaded_bytes", "removed_bytes", "downloaded_files", "cleaned_files")
    return rows.agg(
        *(F.coalesce(F.sum(c), zero).alias(name) for c, name in zip(names, STATS_COUNTERS)),
        F.min(F.when(worked, F.col("at"))).alias("start_time"),
        F.max(F.when(worked, F.col("at"))).alias("last_update"),
    )


def recover_ledger(spark: SparkSession, layout: Layout, at: Column | None = None) -> int:
    """Write a lost ledger anew from the outputs that are there; how many archives it names.

    Does nothing if the ledger has rows. What an output holds is not counted: its archive is
    done, with nothing removed and an unknown number of records. An archive that left no
    output, or only part of one in a batch that was interrupted, cannot be told from the outputs:
    the first comes again, the second does not.
    """
    if not read_table(spark, layout.ledger, LEDGER_DDL).isEmpty():
        return 0
    at = _fixed(spark, at)
    rows = _done_rows(corpus_outputs(spark, layout.corpus), at)
    _append(rows.repartition("batch"), layout.ledger)
    return read_table(spark, layout.ledger, LEDGER_DDL).count()


def _done_rows(outputs: DataFrame, at: Column) -> DataFrame:
    """Ledger rows of outputs(basename, length, batch, attempt) that nobody counted."""
    unknown, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    return outputs.select(
        "basename",
        F.col("length").alias("input_bytes"),
        unknown.alias("kept_records"),
        unknown.alias("output_bytes"),
        zero.alias("removed_bytes"),
        at.alias("at"),
        "attempt",
        "batch",
    )


def totals(spark: SparkSession, layout: Layout) -> DataFrame:
    downloads = read_table(spark, layout.fetch_log, FETCH_LOG_DDL).where("status = 'downloaded'")
    cleaned = ledger_rows(spark, layout)
    return ledger_ops.run_totals(
        downloads.select("basename", "bytes", "at"), cleaned.select("basename", "removed_bytes", "at")
    )


def export_state(spark: SparkSession, layout: Layout, folder: str) -> None:
    """Statistics and tracker documents under folder/stats and folder/tracker.

    Names go to documents of bounded size; the counters are in one of their own.
    """
    row = totals(spark, layout)
    counters = row.select(
        *STATS_COUNTERS,
        to_iso("start_time").alias(STATS_TIMES[0]),
        to_iso("last_update").alias(STATS_TIMES[1]),
        F.array().cast("array<string>").alias(STATS_NAMES),
    )
    write_state_json(counters, f"{folder}/stats")
    downloads = read_table(spark, layout.fetch_log, FETCH_LOG_DDL).where("status = 'downloaded'")
    write_state_json(name_documents(downloads.select("basename"), STATS_NAMES), f"{folder}/stats_names")
    ledger = ledger_rows(spark, layout)
    write_state_json(name_documents(ledger.select("basename")), f"{folder}/tracker")
