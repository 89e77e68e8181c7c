"""Copying archives into the landing folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pagemill.constants import COPY_CHUNK_BYTES
from pagemill.sources.files import discard, open_input, open_output, rename, size_text

FETCH_DDL = "basename STRING, url STRING, path STRING, bytes BIGINT, status STRING, error STRING"


def copy_file(url: str, target: str, attempt: str) -> int:
    """Copy through a partial file and rename; an error removes the partial file.

    The name starts with a dot, so that Spark never lists what a lost task left.
    """
    folder, _, name = target.rpartition("/")
    partial = f"{folder}/.{name}.{attempt}.part"
    copied = 0
    try:
        with open_input(url) as source, open_output(partial) as sink:
            while chunk := source.read(COPY_CHUNK_BYTES):
                sink.write(chunk)
                copied += len(chunk)
            # an HTTP connection that ends early reads like the end of the file
            promised = getattr(source, "headers", {}).get("Content-Length")
            if promised is not None and promised.strip().isdigit() and int(promised) != copied:
                raise OSError(f"{copied} of {promised} bytes came")
        rename(partial, target)
    except BaseException:
        discard(partial)
        raise
    return copied


def lookup_sizes(wanted: DataFrame, tasks: int) -> DataFrame:
    """wanted(basename, url) -> basename, content_length of every file that answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, sizes = [], []
            for r in batch.to_pylist():
                try:
                    size = size_text(r["url"])
                except Exception:  # no row: the lookup failed
                    continue
                names.append(r["basename"])
                sizes.append(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(sizes, pa.string())],
                names=["basename", "content_length"],
            )

    rows = wanted.select("basename", "url").repartition(tasks)
    return rows.mapInArrow(run, "basename STRING, content_length STRING")


def fetch(wanted: DataFrame, folder: str, tasks: int) -> DataFrame:
    """wanted(basename, url), one row per basename -> FETCH_DDL, status downloaded or failed.

    Runs once per evaluation: write the result to a table and read that. A task
    that is run again, or twice at once, uses its own partial file and renames
    over the same target.
    """
    folder = folder.rstrip("/")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        attempt = str(context.taskAttemptId()) if context else "0"
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                target = f"{folder}/{r['basename']}"
                try:
                    size, status, error = copy_file(r["url"], target, attempt), "downloaded", None
                except Exception as e:  # any failure is an outcome of this file only
                    size, status, error, target = None, "failed", f"{type(e).__name__}: {e}", None
                rows.append((r["basename"], r["url"], target, size, status, error))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(v, pa.int64() if i == 3 else pa.string())
                        for i, v in enumerate(zip(*rows))
                    ],
                    names=["basename", "url", "path", "bytes", "status", "error"],
                )

    return wanted.select("basename", "url").repartition(tasks).mapInArrow(run, FETCH_DDL)
