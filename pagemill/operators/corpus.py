"""Ordered text output per archive, and what each archive contributed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pagemill.constants import MIN_TEXT_LENGTH, RECORD_SEPARATOR
from pagemill.functions.text import byte_length

CHUNK_SPAN = 1 << 30  # bytes of an archive that end up in one output file
TASK_BYTES = 128 << 20  # text that one writing task should hold


def chunk_of(position: str = "rec_offset", span: int = CHUNK_SPAN) -> Column:
    return F.expr(f"`{position}` div {span}").alias("chunk")


def write_corpus(
    clean: DataFrame,
    folder: str,
    span: int = CHUNK_SPAN,
    text_bytes: int = 0,
    mode: str = "dynamic",
) -> None:
    """Write basename=<b>/chunk=<n>/part-*.txt; the chunks of an archive in order are its text.

    Every record is followed by the separator. An archive up to `span` bytes is
    one file; a larger one is cut by record position, so no task holds a whole
    huge archive and the order needs no global sort. Archives without records
    leave no output. Records are ordered by rec_offset, then rec_number where
    there is one; `at`, where there is one, is the position that cuts. `text_bytes`, when known, raises the number of tasks beyond
    the session's default. Mode dynamic replaces the chunks that are written
    (chunks a shorter rewrite no longer has stay), static replaces the folder.
    """
    tasks = int(clean.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = text_bytes // TASK_BYTES
    order = [c for c in ("rec_offset", "rec_number") if c in clean.columns]
    at = "at" if "at" in clean.columns else "rec_offset"
    rows = clean.select(
        # not nullable: otherwise the writer wraps the column and sorts once more
        F.coalesce("basename", F.lit("")).alias("basename"),
        F.coalesce(chunk_of(at, span), F.lit(0).cast("bigint")).alias("chunk"),
        *order,
        F.col("text").alias("value"),
    )
    (
        # without a number AQE may merge small partitions
        rows.repartition(*([wanted] if wanted > tasks else []), "basename", "chunk")
        .sortWithinPartitions("basename", "chunk", *order)
        .select("value", "basename", "chunk")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("lineSep", RECORD_SEPARATOR)
        .partitionBy("basename", "chunk")
        .text(folder)
    )


def read_corpus(spark: SparkSession, folder: str, *outer: str) -> DataFrame:
    """basename, chunk, value: one row per record; `outer` names folders above basename=<b>."""
    names = "".join(f", {name} STRING" for name in outer)
    schema = StructType.fromDDL(f"value STRING, basename STRING, chunk BIGINT{names}")
    return (
        spark.read.schema(schema)
        .option("lineSep", RECORD_SEPARATOR)
        .text(folder)
        .select("basename", "chunk", "value", *outer)
    )


def list_outputs(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """path, length of the output files; contents are not read. Empty files do not count."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )


def pack_text(
    rows: DataFrame, key: str, position: str, text: str, span: int, separator: str = RECORD_SEPARATOR
) -> DataFrame:
    """key, chunk, n_records, packed: texts in order, each followed by the separator.

    A chunk covers `span` positions, so a value stays bounded however many rows
    a key has; the chunks of a key in order are its whole text.
    """
    placed = F.struct(F.col(position).alias("p"), F.col(text).alias("t"))
    return (
        rows.select(key, chunk_of(position, span), position, text)
        .groupBy(key, "chunk")
        .agg(
            F.count(F.lit(1)).alias("n_records"),
            F.array_sort(F.collect_list(placed)).alias("_r"),
        )
        .select(
            key,
            "chunk",
            "n_records",
            F.concat(
                F.array_join(F.transform("_r", lambda r: r["t"]), separator), F.lit(separator)
            ).alias("packed"),
        )
    )


def record_metrics(rows: DataFrame, kept: Column, failed: Column) -> DataFrame:
    """basename, kept_records, output_bytes, errors; summed on the map side first."""
    size = byte_length("text") + F.octet_length(F.lit(RECORD_SEPARATOR))
    return rows.groupBy("basename").agg(
        F.count_if(kept).alias("kept_records"),
        F.sum(F.when(kept, size)).alias("output_bytes"),
        F.count_if(failed).alias("errors"),
    )


def file_metrics(
    files: DataFrame,
    rows: DataFrame,
    kept: Column | None = None,
    failed: Column | None = None,
) -> DataFrame:
    """One row per file(basename, length), also for files that kept nothing.

    `kept` and `failed` tell which rows are clean text and which report an
    error; without them every row is clean text. removed_bytes may be negative:
    the input is compressed, the output is not.
    """
    kept = F.lit(True) if kept is None else kept
    per_file = record_metrics(rows, kept, F.lit(False) if failed is None else failed)
    zero = F.lit(0).cast("bigint")
    return (
        files.select("basename", F.col("length").alias("input_bytes"))
        .join(per_file, "basename", "left")
        .select(
            "basename",
            "input_bytes",
            F.coalesce("kept_records", zero).alias("kept_records"),
            F.coalesce("output_bytes", zero).alias("output_bytes"),
            (F.col("input_bytes") - F.coalesce("output_bytes", zero)).alias("removed_bytes"),
            *([F.coalesce("errors", zero).alias("errors")] if failed is not None else []),
        )
    )


def finished_outputs(
    files: DataFrame, outputs: DataFrame, min_len: int = MIN_TEXT_LENGTH
) -> DataFrame:
    """Files that need no work: their output is larger than min_len bytes."""
    return files.join(
        outputs.where(F.col("length") > min_len).select("basename"), "basename", "left_semi"
    )
