"""`df.write.format("corpus")`: one text file per archive, none of them visible before it is whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from pagemill.constants import OUTPUT_SUFFIX, RECORD_SEPARATOR
from pagemill.sources.files import discard, open_output, rename

CORPUS_COLUMNS = ["basename", "value"]


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, str]] = field(default_factory=list)  # where it is, where it is to be


class _CorpusWriter(DataSourceArrowWriter):
    """Tasks write hidden files; the commit renames them, an abort removes them."""

    def __init__(self, folder: str):
        self._folder = folder.rstrip("/")
        self._job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        attempt = TaskContext.get().taskAttemptId()
        done, name, sink, partial = _Written(), None, None, None
        end = RECORD_SEPARATOR.encode()

        def finish() -> None:
            if sink is not None:
                sink.close()
                done.files.append((partial, f"{self._folder}/{name}{OUTPUT_SUFFIX}"))

        try:
            for batch in iterator:
                names = batch.column("basename")
                texts = pc.coalesce(batch.column("value"), pa.scalar("")).cast(pa.binary())
                for key, text in zip(names.to_pylist(), texts):
                    if sink is None or key != name:
                        finish()
                        name = key
                        partial = f"{self._folder}/.{name}.{self._job}.{attempt}.part"
                        sink = open_output(partial)
                    sink.write(text.as_buffer())
                    sink.write(end)
            finish()
        except BaseException:
            for path in {partial, *(p for p, _ in done.files)} - {None}:
                discard(path)
            raise
        return done

    def commit(self, messages: list[_Written | None]) -> None:
        for message in messages:
            for partial, target in message.files if message else ():
                rename(partial, target)

    def abort(self, messages: list[_Written | None]) -> None:
        for message in messages:
            for partial, _ in message.files if message else ():
                discard(partial)


class CorpusDataSource(DataSource):
    """Writes rows of basename and value, which must come with the rows of a basename side by side."""

    @classmethod
    def name(cls) -> str:
        return "corpus"

    def schema(self) -> str:
        return ", ".join(f"{c} STRING" for c in CORPUS_COLUMNS)

    def writer(self, schema: StructType, overwrite: bool) -> _CorpusWriter:
        if schema.names != CORPUS_COLUMNS:
            raise ValueError(f"a corpus has the columns {CORPUS_COLUMNS}")
        return _CorpusWriter(self.options["path"])


def write_corpus_files(clean: DataFrame, folder: str) -> None:
    """clean(basename, rec_offset[, rec_number], text) -> <basename>.txt, its records in order.

    Every record is followed by the separator; an archive without records has no file,
    and one that has a file already gets another in its place. A task writes whole archives, as a
    stream: Spark sorts their records and spills if it must. Files appear when the whole
    job is done, each of them at once; none does if it fails.
    """
    order = [c for c in ("rec_offset", "rec_number") if c in clean.columns]
    clean.sparkSession.dataSource.register(CorpusDataSource)
    (
        clean.repartition("basename")
        .sortWithinPartitions("basename", *order)
        .select("basename", F.col("text").alias("value"))
        .write.format("corpus")
        .mode("append")
        .save(folder)
    )


def read_corpus_files(spark: SparkSession, folder: str) -> DataFrame:
    """basename, value: a row a record."""
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))
    rows = spark.read.option("lineSep", RECORD_SEPARATOR).option("pathGlobFilter", f"*{OUTPUT_SUFFIX}")
    return rows.text(folder).select(
        F.substring(name, F.lit(1), F.length(name) - len(OUTPUT_SUFFIX)).alias("basename"), "value"
    )
