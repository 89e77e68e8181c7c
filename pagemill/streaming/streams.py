"""The same work as Structured Streaming queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from pagemill.constants import BASE_URL, FILES_IN_FLIGHT, SAVE_INTERVAL_SECONDS
from pagemill.functions.text import node_label
from pagemill.operators.manifest import read_manifest, resolve_lines
from pagemill.operators.retries import Retry
from pagemill.plans.batch import Layout, run_batch, run_fetch
from pagemill.plans.retry import run_retries
from pagemill.session import settings
from pagemill.streaming.active import CHANGES_DDL, LATE_SECONDS, ActiveWorkers, name_place, named_place
from pagemill.streaming.downloads import EFFECTS_DDL, DownloadsInEffect

VIEW_DDL = "worker BIGINT, node STRING, filename STRING"
EFFECT_DDL = "key STRING, amount BIGINT"
VIEW_SLOTS = 4  # a reader has as many batches' time, less one, before its place is written again
# state in RocksDB; no batches without messages, which would follow one another without end
_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
_FILE_COLUMNS = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _start(writer: DataStreamWriter, checkpoint: str, drain: bool) -> StreamingQuery:
    """Until drained, or forever with state saved at a fixed interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    if drain:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{SAVE_INTERVAL_SECONDS} seconds").start()


def _names(spark: SparkSession, batch_id: int) -> dict[str, str]:
    """Names tied to the checkpoint: a new checkpoint never replaces older batches."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    return {"run": query, "batch": f"{query}-{batch_id}"}


def fetch_stream(
    spark: SparkSession,
    manifest_folder: str,
    layout: Layout,
    base_url: str = BASE_URL,
    drain: bool = True,
    **options,
) -> StreamingQuery:
    """New manifest files -> archives in the landing folder."""
    lines = spark.readStream.text(manifest_folder)

    def each(batch: DataFrame, batch_id: int) -> None:
        manifest = resolve_lines(batch, base_url=base_url)
        names = _names(spark, batch_id)
        run_fetch(batch.sparkSession, manifest, layout, base_url=base_url, **names, **options)

    return _start(lines.writeStream.foreachBatch(each), layout.folder("checkpoints/fetch"), drain)


def clean_stream(
    spark: SparkSession,
    layout: Layout,
    files_per_batch: int = FILES_IN_FLIGHT,
    clean_source: str = "off",
    drain: bool = True,
    pattern: str = "*",
    **options,
) -> StreamingQuery:
    """New archives in the landing folder -> corpus and ledger.

    A batch takes `files_per_batch` archives: take many more on a large cluster.
    `clean_source` is Spark's option of that name: off, archive or delete. Files
    are removed only after the batch that cleaned them was committed.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_COLUMNS)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", str(files_per_batch))
        .option("cleanSource", clean_source)
    )
    if clean_source == "archive":
        reader = reader.option("sourceArchiveDir", layout.folder("done"))
    files = reader.load(layout.landing).select("path", "length")

    def each(batch: DataFrame, batch_id: int) -> None:
        run_batch(batch.sparkSession, batch, layout, **_names(spark, batch_id), **options)

    return _start(files.writeStream.foreachBatch(each), layout.folder("checkpoints/clean"), drain)


def retry_stream(
    spark: SparkSession,
    manifest_folder: str,
    layout: Layout,
    base_url: str = BASE_URL,
    policy: Retry = Retry(),
    started: datetime | None = None,
    drain: bool = True,
    fetch_options: dict | None = None,
    **clean_options,
) -> StreamingQuery:
    """At every trigger, another attempt for the files that are due by then (see `run_retries`).

    The source only ticks; what is pending is looked up when it does. So a file
    comes again however often a stream has seen it, and also one that came late. What failed
    before `started` (default: now) is due at once; drained, that is one attempt a call.
    """
    since = F.lit(started or datetime.now(timezone.utc))
    ticks = (
        spark.readStream.format("rate-micro-batch").option("rowsPerBatch", "1").option("numPartitions", "1")
    ).load()

    def each(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run_retries(
            session,
            read_manifest(session, manifest_folder, base_url),
            layout,
            since,
            policy,
            base_url,
            **_names(session, batch_id),
            fetch_options=fetch_options,
            **clean_options,
        )

    return _start(ticks.writeStream.foreachBatch(each), layout.folder("checkpoints/retry"), drain)


def active_worker_stream(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    cores_per_node: int,
    drain: bool = True,
    late_seconds: int = LATE_SECONDS,
) -> StreamingQuery:
    """Stream of messages(worker, seq, filename, status) -> current view, see `active_view`.

    State is one row per active worker, in RocksDB; it goes when the worker ends. The last number of
    an ended worker is kept for `late_seconds`, so that a late start does not bring it back.
    Each batch writes the view to another place and then names that place, so
    that readers never meet a table that is being written.
    """
    changes = (
        messages.select("worker", "seq", "filename", "status")
        .groupBy("worker")
        .transformWithStateInPandas(
            ActiveWorkers(late_seconds), CHANGES_DDL, outputMode="Update", timeMode="ProcessingTime"
        )
    )
    node = node_label("worker", cores_per_node).alias("node")
    return _view_stream(
        changes, table, checkpoint, drain, CHANGES_DDL, VIEW_DDL, ["worker", node, "filename"]
    )


def effect_stream(
    events: DataFrame, table: str, checkpoint: str, delay: str = "1 day", drain: bool = True
) -> StreamingQuery:
    """Stream of events(key, seq, amount, at, kind) -> the download in effect of each file, see `effect_view`.

    Events may come in any order that keeps them within `delay` of the latest; those that come
    later are left out.
    """
    changes = (
        events.selectExpr("CAST(key AS STRING) AS key", "seq", "amount", "CAST(at AS TIMESTAMP) AS at", "kind")
        .withWatermark("at", delay)
        .groupBy("key")
        .transformWithStateInPandas(
            DownloadsInEffect(), EFFECTS_DDL, outputMode="Update", timeMode="EventTime"
        )
    )
    return _view_stream(changes, table, checkpoint, drain, EFFECTS_DDL, EFFECT_DDL, ["key", "amount"])


def _view_stream(
    changes: DataFrame, table: str, checkpoint: str, drain: bool, ddl: str, view_ddl: str, columns: list
) -> StreamingQuery:
    """Changes of keyed state (the first column: key; seq; active: whether the key stays) -> view of all keys."""
    spark = changes.sparkSession
    key = changes.columns[0]
    values = [c for c in changes.columns if c not in (key, "seq", "active")]

    def each(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # written first: the plan of the batch changes the state whenever it runs
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{table}/changes")
        changed = session.read.schema(ddl).parquet(f"{table}/changes")
        last = changed.groupBy(key).agg(F.max_by(F.struct(*values, "active"), "seq").alias("c"))
        place = f"{table}/slot={batch_id % VIEW_SLOTS}"
        began = last.where("c.active").select(key, *[f"c.{v}" for v in values])
        before = _view(session, table, view_ddl).select(key, *values).join(last, key, "left_anti")
        rows = before.unionByName(began).select(*columns)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(place)
        name_place(table, place)

    with settings(spark, _STATE_SETTINGS):  # a query takes them along when it starts
        return _start(changes.writeStream.outputMode("update").foreachBatch(each), checkpoint, drain)


def _view(spark: SparkSession, table: str, ddl: str) -> DataFrame:
    place = named_place(table)
    return spark.read.schema(ddl).parquet(place) if place else spark.createDataFrame([], ddl)


def active_view(spark: SparkSession, table: str) -> DataFrame:
    """worker, node, filename as of the last batch of the stream; no rows before the first."""
    return _view(spark, table, VIEW_DDL)


def effect_view(spark: SparkSession, table: str) -> DataFrame:
    """key, amount: files with a download in effect, as of the last batch of the stream."""
    return _view(spark, table, EFFECT_DDL)
