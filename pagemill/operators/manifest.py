"""Which archives are to be fetched: manifest lines, sizes, what is done already."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pagemill.constants import BASE_URL
from pagemill.functions.text import basename, estimated_size, needed_space, strip

_LINES = StructType([StructField("value", StringType())])


def resolve_lines(lines: DataFrame, line: str = "value", base_url: str = BASE_URL) -> DataFrame:
    """Manifest lines -> their other columns + rel_path, basename, url.

    A line counts unless it is blank or starts with '#' before stripping.
    """
    rel = strip(F.col(line))
    return (
        lines.where(~F.col(line).startswith("#"))
        .withColumn("rel_path", rel)
        .where(F.col("rel_path") != "")
        .drop(line)
        .withColumn("basename", basename("rel_path"))
        .withColumn("url", F.concat(F.lit(base_url), F.col("rel_path")))
    )


def read_manifest(spark: SparkSession, path: str, base_url: str = BASE_URL) -> DataFrame:
    """Manifest file(s); a missing manifest is an empty one."""
    try:
        lines = spark.read.schema(_LINES).text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([], _LINES)
    return resolve_lines(lines, base_url=base_url)


def one_path_per_basename(manifest: DataFrame) -> DataFrame:
    """The smallest path of every basename; pre-aggregated before the shuffle."""
    return manifest.groupBy("basename").agg(F.min("rel_path").alias("rel_path"))


def skip_cleaned(manifest: DataFrame, ledger: DataFrame, key: str = "basename") -> DataFrame:
    """Manifest rows whose key is not in the ledger.

    The ledger holds one row per key, so either side may be broadcast when AQE
    finds it small, and a hot key on the left is split by AQE when it is not.
    """
    return manifest.join(ledger.select(key), key, "left_anti")


def with_sizes(
    manifest: DataFrame, listing: DataFrame, key: str = "basename", length: str = "content_length"
) -> DataFrame:
    """Attach the length text of the listing; `found` tells a failed lookup from an unknown length."""
    sizes = listing.select(key, F.col(length), F.lit(True).alias("found"))
    return manifest.join(sizes, key, "left").withColumn(
        "found", F.coalesce("found", F.lit(False))
    )


def size_status(
    content_length: Column | str, budget_bytes: int | None = None, found: Column | None = None
) -> Column:
    """head_failed / size_zero / no_capacity / NULL when the file is to be fetched."""
    size = estimated_size(content_length)
    status = F.when(F.lit(False) if found is None else ~found, F.lit("head_failed"))
    status = status.when(size == 0, F.lit("size_zero"))
    if budget_bytes is not None:
        status = status.when(needed_space(size) > budget_bytes, F.lit("no_capacity"))
    return status
