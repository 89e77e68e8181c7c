"""Archives as rows.

`scan_archives` works from a DataFrame of files, so a listing of any size stays
distributed; `spark.read.format("warc")` reads a path.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    In,
    InputPartition,
    IsNotNull,
    StringContains,
)

from pagemill.functions.text import basename
from pagemill.session import give_back
from pagemill.sources.archive_reader import first_member, is_gzip, read_range
from pagemill.sources.files import list_files, listed_files, open_input

SPLIT_BYTES = 128 * 1024 * 1024
_BATCH_BYTES = 16 * 1024 * 1024
_BATCH_ROWS = 1000

RECORD_DDL = (
    "path STRING, basename STRING, rec_offset BIGINT, rec_type STRING, content_type STRING, "
    "http_headers MAP<STRING,STRING>, payload BINARY, error STRING, rec_number BIGINT"
)
# rec_offset is where the record's gzip member begins, rec_number counts within it; `at` is how far
# the archive had been read, in bytes of the file
SCAN_DDL = RECORD_DDL + ", kind STRING, next_offset BIGINT, at BIGINT"
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("basename", pa.string()),
        ("rec_offset", pa.int64()),
        ("rec_type", pa.string()),
        ("content_type", pa.string()),
        ("http_headers", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
        ("error", pa.string()),
        ("rec_number", pa.int64()),
        ("kind", pa.string()),
        ("next_offset", pa.int64()),
        ("at", pa.int64()),
    ]
)


def _range_rows(path, name, start, end, html_only, with_payload) -> Iterator[tuple]:
    """Rows in the column order of SCAN_DDL; a failure becomes a row, not an exception."""

    def failed(reason: str) -> tuple:
        return path, name, None, None, None, None, None, reason, None, "error", None, None

    try:
        with open_input(path) as raw:
            for row in read_range(raw, start, end, html_only, with_payload):
                if row[0] == "record":
                    _, offset, rec_type, content_type, http, payload, number, at = row
                    yield (
                        path, name, offset, rec_type, content_type,
                        None if http is None else list(http.items()),
                        payload, None, number, "record", None, at,
                    )
                else:
                    yield (
                        path, name, row[1], None, None, None, None, None, None, "split", row[2], None,
                    )
    except FileNotFoundError:
        yield failed("missing")
    except Exception as e:  # whatever one archive holds must not end the job
        yield failed(f"{type(e).__name__}: {e}")


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[6] or b"") + 512
        if size >= _BATCH_BYTES or len(held) >= _BATCH_ROWS:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), _ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


@dataclass(frozen=True)
class ScanSize:
    files: int
    ranges: int
    tasks: int


def scan_size(files: DataFrame, split_bytes: int | None = SPLIT_BYTES) -> ScanSize:
    """How much there is to read; looks at the listing only."""
    ranges = F.greatest(F.ceil(F.col("length") / F.lit(split_bytes)), F.lit(1)) if split_bytes else F.lit(1)
    n_files, n_ranges = files.agg(F.count(F.lit(1)), F.coalesce(F.sum(ranges), F.lit(0))).first()
    # about four ranges per task: a lost task costs little, and tasks even out
    cores = files.sparkSession.sparkContext.defaultParallelism
    return ScanSize(n_files, int(n_ranges), max(cores, int(n_ranges) // 4))


def scan_archives(
    files: DataFrame,
    tasks: int | None = None,
    html_only: bool = True,
    with_payload: bool = True,
    split_bytes: int | None = SPLIT_BYTES,
) -> DataFrame:
    """files(path, basename, length) -> SCAN_DDL.

    An archive is read in byte ranges by many tasks. Besides its records, every
    range reports where its first record starts and where the next range should
    start (`kind = 'split'`); `broken_splits` compares the two. `split_bytes`
    None reads every archive in one piece. Without `tasks` the listing is summed
    up first to find a good number.
    """
    last = F.greatest(F.col("length") - 1, F.lit(0))
    if split_bytes:
        starts = F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(split_bytes)))
    else:
        starts = F.lit(0).cast("bigint")
    ranges = files.select("path", "basename", starts.alias("start")).select(
        "path",
        "basename",
        "start",
        (F.col("start") + split_bytes if split_bytes else F.lit(None).cast("bigint")).alias("stop"),
    )
    tasks = tasks or scan_size(files, split_bytes).tasks

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield from _batches(
                    _range_rows(
                        r["path"], r["basename"], r["start"], r["stop"], html_only, with_payload
                    )
                )
                give_back()

    # ranges are tiny rows; a fixed number of partitions keeps AQE from merging them
    return ranges.repartition(tasks).mapInArrow(read, SCAN_DDL)


def broken_splits(scan: DataFrame) -> DataFrame:
    """path of every archive whose ranges do not join up.

    Range starts are found by looking for something that looks like a record,
    which a payload may imitate. All starts are right exactly when every place
    where a range stopped is where another one started, and the other way round.
    """
    marks = scan.where("kind = 'split'")
    started = marks.where("rec_offset > 0").selectExpr("path", "rec_offset AS place", "1 AS n")
    stopped = marks.where("next_offset IS NOT NULL").selectExpr(
        "path", "next_offset AS place", "-1 AS n"
    )
    return (
        started.unionAll(stopped)
        .groupBy("path", "place")
        .agg(F.sum("n").alias("n"))
        .where("n <> 0")
        .select("path")
        .distinct()
    )


def records(scan: DataFrame) -> DataFrame:
    return scan.where("kind = 'record'").drop("kind", "next_offset", "at")


@dataclass(frozen=True)
class _Part:
    path: str
    length: int
    start: int
    stop: int | None  # None: to the end


@dataclass
class _Range(InputPartition):
    parts: list[_Part]


def plan_ranges(files: list[tuple[str, int]], split_bytes: int | None) -> list[_Range]:
    """Tasks of about `split_bytes`: large archives in several ranges, small ones together."""
    tasks: list[_Range] = []
    held, size = [], 0
    for path, length in files:
        if not split_bytes:
            tasks.append(_Range([_Part(path, length, 0, None)]))
        elif length > split_bytes:
            starts = range(0, length, split_bytes)
            tasks += [_Range([_Part(path, length, at, at + split_bytes)]) for at in starts]
        else:
            if held and size + length > split_bytes:
                tasks.append(_Range(held))
                held, size = [], 0
            held.append(_Part(path, length, 0, None))
            size += length
    return tasks + ([_Range(held)] if held else [])


def _unmet(part: _Part, end: int | None, split_bytes: int) -> str | None:
    """What is wrong if the ranges behind one that ended at `end` do not begin there.

    The first range of an archive begins right. If each one finds that the next record after its own
    is where the next range will begin, all of them do, whatever payloads look like.
    """
    with open_input(part.path) as raw:
        gzipped = is_gzip(raw)
        for start in range(part.stop, part.length if end is None else end + 1, split_bytes):
            stop = start + split_bytes
            begins = first_member(raw, start, stop, gzipped)
            if begins != (end if end is not None and start <= end < stop else None):
                return f"a range begins at {begins}, the one before it ends at {end}: read without splitBytes"
    return None


class _WarcReader(DataSourceReader):
    def __init__(self, options):
        self.root = options.get("path")
        self.listing = options.get("listing")
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.with_payload = options.get("payload", "true").lower() == "true"
        self.html_only = options.get("htmlOnly", "false").lower() == "true"
        self.checks = []

    def partitions(self):
        files = list_files(self.root) if self.listing is None else listed_files(self.listing)
        return plan_ranges(files, self.split_bytes)

    def read(self, partition):
        rows = (row for part in partition.parts for row in self._rows(part))
        for batch in _batches(row for row in rows if self._keeps(row)):
            yield batch.select(_ARROW.names[:9])

    def _rows(self, part: _Part) -> Iterator[tuple]:
        name = part.path.rstrip("/").rsplit("/", 1)[-1]
        for row in _range_rows(
            part.path, name, part.start, part.stop, self.html_only, self.with_payload
        ):
            if row[9] != "split":
                yield row
            elif part.stop is not None and row[2] is not None:  # a range that had records
                wrong = _unmet(part, row[10], self.split_bytes)
                if wrong:
                    yield part.path, name, None, None, None, None, None, wrong, None, "error", None, None

    def _keeps(self, row) -> bool:
        # rows that report an error always pass; Spark filters again what it must
        return row[9] == "error" or all(check(row) for check in self.checks)


class _FilteringWarcReader(_WarcReader):
    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") else None
            at = _ARROW.names.index(column) if column in _ARROW.names[:9] else None
            if at is not None and isinstance(f, In):
                self.checks.append(lambda row, at=at, v=frozenset(f.value): row[at] in v)
            elif at is not None and isinstance(f, StringContains):
                self.checks.append(lambda row, at=at, v=f.value: v in (row[at] or ""))
            elif at is not None and isinstance(f, IsNotNull):
                self.checks.append(lambda row, at=at: row[at] is not None)
            yield f  # Spark evaluates every filter again


class WarcDataSource(DataSource):
    """`spark.read.format("warc")`.

    Options: `payload` (default true), `htmlOnly` (default false), `pushdown`
    (default false; needs spark.sql.python.filterPushdown.enabled), `splitBytes` (default
    128 MiB; 0 reads every archive in one piece) and, instead of a path, `listing`: a Parquet
    table with path and length, as `archive_listing` makes it from folders of any size.

    A range that does not begin where the one before it ended is a row with an error: an archive
    without such rows was read rightly.
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return RECORD_DDL

    def reader(self, schema):
        pushdown = self.options.get("pushdown", "false").lower() == "true"
        return (_FilteringWarcReader if pushdown else _WarcReader)(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def archive_listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """files(path, basename, length) of a folder; contents are not read. Empty files are skipped."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", basename("path").alias("basename"), "length")
    )
