"""Reading and writing the two state documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from pagemill.constants import STATS_COUNTERS, STATS_NAMES, STATS_TIMES, TRACKER_NAMES

NAMES_PER_DOCUMENT = 10_000
DOCUMENT_END = "\x1e"  # the record separator: JSON has it nowhere, not even inside a string

STATS_SCHEMA = StructType(
    [StructField(c, LongType()) for c in STATS_COUNTERS]
    + [StructField(c, StringType()) for c in STATS_TIMES]
    + [StructField(STATS_NAMES, ArrayType(StringType()))]
)
TRACKER_SCHEMA = StructType([StructField(TRACKER_NAMES, ArrayType(StringType()))])


def stats_defaults(now_iso: Column) -> dict[str, Column]:
    zero = F.lit(0).cast("bigint")
    return (
        {c: zero for c in STATS_COUNTERS}
        | {c: now_iso for c in STATS_TIMES}
        | {STATS_NAMES: F.array().cast("array<string>")}
    )


def tracker_defaults() -> dict[str, Column]:
    return {TRACKER_NAMES: F.array().cast("array<string>")}


def read_state_json(
    spark: SparkSession,
    path: str,
    schema: StructType,
    defaults: Mapping[str, Column],
    many_per_file: bool = False,
) -> DataFrame:
    """One row per document; an unreadable document, or an absent key, gives the default.

    A file is one document or, with `many_per_file`, any number of them, each followed by
    DOCUMENT_END (see `write_documents`).
    """
    read = StructType(schema.fields + [StructField("_corrupt_record", StringType())])
    reader = spark.read.schema(read)
    reader = reader.option("lineSep", DOCUMENT_END) if many_per_file else reader.option("multiLine", "true")
    rows = reader.json(path)
    return rows.select(*(F.coalesce(c, defaults[c]).alias(c) for c in schema.fieldNames()))


def tracked_names(documents: DataFrame, names: str = TRACKER_NAMES) -> DataFrame:
    """basename: every name in the documents, once."""
    return documents.select(F.explode(names).alias("basename")).distinct()


def write_state_json(documents: DataFrame, path: str) -> None:
    """One indented JSON document per row."""
    body = F.to_json(F.struct(*documents.columns), {"pretty": "true", "ignoreNullFields": "false"})
    # each document becomes a file of its own: readers take one document per file
    (
        documents.select(body.alias("value"), F.monotonically_increasing_id().alias("document"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("document")
        .text(path)
    )


def write_documents(texts: DataFrame, path: str) -> None:
    """texts(value): documents as they are, whole or not, as many to a file as a task has."""
    texts.select("value").write.mode("overwrite").option("lineSep", DOCUMENT_END).text(path)


def name_documents(
    names: DataFrame, field: str = TRACKER_NAMES, per_document: int = NAMES_PER_DOCUMENT
) -> DataFrame:
    """Names as documents of about `per_document` sorted names each.

    A list of all names in one value would pass through one task, so a long
    list is spread over several documents of the same shape.
    """
    distinct = names.select(F.col(names.columns[0]).alias("basename")).distinct()
    shards = max(1, -(-distinct.count() // per_document))
    return (
        distinct.groupBy(F.pmod(F.xxhash64("basename"), F.lit(shards)).alias("shard"))
        .agg(F.array_sort(F.collect_list("basename")).alias(field))
        .select(field)
    )
