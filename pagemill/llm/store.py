"""Files of this subpackage's own formats, in the folder the cluster shares."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pagemill.session import give_back, scratch_dir  # noqa: F401
from pagemill.sources import files


def folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under `spark.checkpoint.dir`."""
    return scratch_dir(spark, purpose)


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows from a table in the shared folder: computed once, kept when executors go."""
    place = folder(frame.sparkSession, purpose)
    frame.write.parquet(place)
    return frame.sparkSession.read.schema(frame.schema).parquet(place)


def dealt(paths: DataFrame, tasks: int | None = None) -> DataFrame:
    """A few wide rows, one to a task as far as possible."""
    spark = paths.sparkSession
    return paths.repartition(tasks or 4 * spark.sparkContext.defaultParallelism)


def write_file(place: str, *parts: bytes) -> str:
    """Write a new file whole or not at all; a repeated task writes another."""
    target = f"{place}/{uuid.uuid4().hex}"
    with files.open_output(f"{target}.part") as out:
        for part in parts:
            out.write(part)
    files.rename(f"{target}.part", target)
    return target


def read_file(path: str) -> bytes:
    with files.open_input(path) as file:
        return file.read()


def free_name(frame: DataFrame, name: str) -> str:
    """`name`, with underscores put before it until no column has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
