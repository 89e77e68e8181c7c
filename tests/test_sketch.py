from pyspark.sql import functions as F

from pagemill.operators.manifest import skip_cleaned
from pagemill.operators.sketch import (
    BITS_PER_NAME,
    key_sketch,
    may_be_known,
    merged_sketches,
    skip_cleaned_by_sketch,
)


def names(spark, numbers):
    return spark.createDataFrame([(f"crawl-{i}.warc.gz",) for i in numbers], "basename STRING")


def test_rows_of_the_exact_join_and_few_names_reach_it(spark):
    ledger = names(spark, range(20_000))
    manifest = names(spark, range(15_000, 60_000)).withColumn("rel_path", F.concat(F.lit("x/"), "basename"))
    bits = BITS_PER_NAME * 20_000
    # sketches of batches, one of them twice
    parts = [names(spark, range(a, a + 5000)) for a in (0, 5000, 5000, 10_000, 15_000)]
    sketch = merged_sketches(*[key_sketch(p, bits) for p in parts])
    assert sorted(map(tuple, sketch.collect())) == sorted(map(tuple, key_sketch(ledger, bits).collect()))
    got = skip_cleaned_by_sketch(manifest, ledger, sketch, bits)
    assert got.columns == manifest.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, skip_cleaned(manifest, ledger).collect()))
    hits = may_be_known(manifest, sketch, bits)
    assert hits.where("hit").join(ledger, "basename", "left_semi").count() == 5000  # none is missed
    new = hits.where("hit").join(ledger, "basename", "left_anti").count()
    assert new < 0.1 * 40_000


def test_empty_and_null(spark):
    none = names(spark, [])
    some = names(spark, range(5)).unionByName(spark.createDataFrame([(None,)], "basename STRING"))
    for ledger in (none, some):
        sketch = key_sketch(ledger.where("basename IS NOT NULL"), 64)
        got = skip_cleaned_by_sketch(some, ledger, sketch, 64)
        assert sorted(map(str, got.collect())) == sorted(map(str, skip_cleaned(some, ledger).collect()))
    assert skip_cleaned_by_sketch(none, some, key_sketch(some, 64), 64).count() == 0


def test_a_bit_at_either_end(spark):
    for bits in (1, 7, 32_768, 32_769):
        ledger = names(spark, range(300))
        got = skip_cleaned_by_sketch(names(spark, range(250, 400)), ledger, key_sketch(ledger, bits), bits)
        assert got.count() == 100
