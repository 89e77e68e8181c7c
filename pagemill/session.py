"""Session settings and the folder for intermediate tables."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # pages are large: bound an Arrow batch by bytes as well as by rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # lets the archive source see C7-style filters when `pushdown` is on
    "spark.sql.python.filterPushdown.enabled": "true",
}

# for the steps that pass whole pages to Python, in whatever session they run
PAGE_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 * 1024 * 1024),
}


def session(master: str | None = None, app: str = "pagemill", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """These settings, until the block ends."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def shared_dir(spark: SparkSession) -> str | None:
    """The folder the cluster names for intermediate data."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else None


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables that every executor can reach.

    It lies under the cluster's `spark.checkpoint.dir`. Only a local session
    without that setting gets a folder on this machine.
    """
    shared = shared_dir(spark)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the executors")
        shared = tempfile.mkdtemp(prefix="pagemill-")
    return f"{shared}/{purpose}-{uuid.uuid4().hex}"


def spread(scan: DataFrame, factor: int = 1) -> DataFrame:
    """Give a plain scan enough partitions to keep every core busy.

    Large inputs already have more splits than the cluster has cores and are
    left alone, so at scale this adds no shuffle. `scan` must be a plain scan:
    counting the partitions of a plan with shuffles would run it.
    """
    wanted = scan.sparkSession.sparkContext.defaultParallelism * factor
    return scan.repartition(wanted) if scan.rdd.getNumPartitions() < wanted else scan
