"""Archives made from table rows, so that a round trip through the reader can be checked."""

from __future__ import annotations

import gzip
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.constants import COPY_CHUNK_BYTES
from pagemill.session import PAGE_BATCHES, give_back, settings
from pagemill.sources.files import open_input, open_output, rename

_ROWS_BYTES = 1024 * 1024  # of a batch that are Python objects at once


def warc_record(rec_type: str, uri: str, block: bytes, content_type: str | None) -> bytes:
    head = f"WARC/1.0\r\nWARC-Type: {rec_type}\r\nWARC-Target-URI: {uri}\r\n"
    if content_type:
        head += f"Content-Type: {content_type}\r\n"
    return head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def arc_record(uri: str, block: bytes, content_type: str | None) -> bytes:
    """A record of the older format: one line of fields, then the block."""
    head = f"{uri} 0.0.0.0 20240101000000 {(content_type or 'no-type').split(';')[0]} {len(block)}\n"
    return head.encode() + block + b"\n"


def http_block(headers: dict[str, str], body: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers.items())
    return b"HTTP/1.1 200 OK\r\n" + lines.encode() + b"\r\n" + body


def batch_rows(batch: pa.RecordBatch, at_once: int = _ROWS_BYTES) -> Iterator[dict]:
    """The rows of a batch, of which about `at_once` bytes are Python objects at a time."""
    step = max(1, len(batch) * at_once // max(1, batch.nbytes))
    for at in range(0, len(batch), step):
        yield from batch.slice(at, step).to_pylist()


def copy_start(source: BinaryIO, sink: BinaryIO, missing_bytes: int) -> None:
    """Copy all but the last bytes, a chunk at a time."""
    held = b""
    while chunk := source.read(COPY_CHUNK_BYTES):
        held += chunk
        ready = max(0, len(held) - missing_bytes)
        sink.write(held[:ready])
        held = held[ready:]


def write_archives(rows: DataFrame, folder: str, arc: bool = False) -> None:
    """rows(basename, rec_offset, rec_type, content_type, url, payload STRING) -> one gzip WARC (or ARC) each.

    The caller bounds the rows of a basename; a task streams its archives to
    disk one after the other. Headers are kept for resource records too.
    """
    folder = folder.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        name, sink, count = None, None, 0

        def finish() -> None:
            if sink:
                sink.close()
                rename(f"{folder}/.{name}.{attempt}", f"{folder}/{name}")

        for batch in batches:
            for r in batch_rows(batch):
                if r["basename"] != name:
                    finish()
                    name = r["basename"]
                    sink = open_output(f"{folder}/.{name}.{attempt}")
                headers = {"X-Position": str(r["rec_offset"])}
                if r["content_type"] is not None:
                    headers["Content-Type"] = r["content_type"]
                block = http_block(headers, r["payload"].encode("utf-8"))
                if arc:
                    record = arc_record(r["url"], block, r["content_type"])
                else:
                    record = warc_record(
                        r["rec_type"], r["url"], block, f"application/http; msgtype={r['rec_type']}"
                    )
                sink.write(gzip.compress(record, 6, mtime=0))
                count += 1
        finish()
        give_back()
        yield pa.RecordBatch.from_pydict({"n": pa.array([count], pa.int64())})

    with settings(rows.sparkSession, PAGE_BATCHES):
        (
            rows.select("basename", "rec_offset", "rec_type", "content_type", "url", "payload")
            .repartition("basename")
            .sortWithinPartitions("basename", "rec_offset")
            .mapInArrow(write, "n BIGINT")
            .agg(F.sum("n"))
            .collect()
        )


def copy_archives(archives: DataFrame, folder: str, missing_bytes: int = 0) -> None:
    """archives(path, basename) -> files of these names in the folder, without their last bytes."""
    folder = folder.rstrip("/")

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for path, name in zip(*(c.to_pylist() for c in batch.columns)):
                with open_input(path) as source, open_output(f"{folder}/.{name}.{attempt}") as sink:
                    copy_start(source, sink, missing_bytes)
                rename(f"{folder}/.{name}.{attempt}", f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    archives.select("path", "basename").mapInArrow(copy, "n BIGINT").agg(F.sum("n")).collect()
