"""Bitmaps of hashed names: most new names are known to be new without a join with the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.operators.manifest import skip_cleaned

BITS_PER_NAME = 16  # about one new name in sixteen then hits a bit that another name has set


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_sketch(names: DataFrame, bits: int, key: str = "basename") -> DataFrame:
    """bucket, bitmap: a bit for each name at its hash modulo `bits`, 32,768 of them in a row.

    Combined on the map side first, so a name may occur however often.
    """
    place = _place(key, bits)
    return names.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap")
    )


def merged_sketches(*sketches: DataFrame) -> DataFrame:
    """The sketch of all names of sketches with the same number of bits: a batch adds its own."""
    union = sketches[0]
    for other in sketches[1:]:
        union = union.unionByName(other)
    return union.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def may_be_known(names: DataFrame, sketch: DataFrame, bits: int, key: str = "basename") -> DataFrame:
    """names + `hit`: false for a name that the sketch surely does not have. Null names do not hit."""
    place = _place(key, bits)
    marked = names.withColumns({"_bucket": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)})
    byte = F.conv(F.hex(F.substring("bitmap", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10)
    hit = F.getbit(byte.cast("bigint"), (F.col("_bit") % 8).cast("int")) == 1
    joined = marked.join(sketch.withColumnRenamed("bucket", "_bucket"), "_bucket", "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in names.columns],
        (F.col(key).isNotNull() & F.coalesce(hit, F.lit(False))).alias("hit"),
    )


def skip_cleaned_by_sketch(
    manifest: DataFrame, ledger: DataFrame, sketch: DataFrame, bits: int, key: str = "basename"
) -> DataFrame:
    """The rows of `skip_cleaned`; only names that hit the sketch of the ledger's names are joined with it.

    The sketch takes BITS_PER_NAME / 8 bytes a name; the join with it is by buckets of 4 KiB, which
    Spark broadcasts if they are few.
    """
    looked_up = may_be_known(manifest, sketch, bits, key)
    new = looked_up.where("NOT hit").drop("hit")
    return new.unionByName(skip_cleaned(looked_up.where("hit").drop("hit"), ledger, key))
