import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pagemill.operators.ledger import downloads_in_effect
from pagemill.streaming import streams

DDL = "key BIGINT, seq BIGINT, amount BIGINT, at TIMESTAMP, kind STRING"


def event(key, seq, kind, amount=None):
    at = datetime(2024, 5, 1) + timedelta(minutes=seq)
    return key, seq, (seq * 10 if amount is None else amount) if kind == "downloaded" else None, at, kind


def run(spark, folder, batches, delay="30 days") -> dict:
    for rows in batches:
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", "1").parquet(f"{folder}/in")
    query = streams.effect_stream(stream, f"{folder}/view", f"{folder}/cp", delay)
    assert query.awaitTermination(100)
    return {r.key: r.amount for r in streams.effect_view(spark, f"{folder}/view").collect()}


def wanted(spark, rows) -> dict:
    found = downloads_in_effect(
        spark.createDataFrame(rows, DDL), "key", "seq", "amount",
        F.col("kind") == "downloaded", F.col("kind") == "reverted",
    )
    return {str(r.key): r.amount for r in found.collect()}


@pytest.mark.parametrize("order", ["forward", "backward", "shuffled"])
def test_order_does_not_matter(spark, tmp_path, order):
    rng = random.Random(3)
    rows = [
        event(rng.randrange(25), seq, rng.choice(["downloaded", "downloaded", "reverted"])) for seq in range(300)
    ]
    want = wanted(spark, rows)
    assert 0 < len(want) <= 25
    if order == "backward":
        rows.reverse()
    if order == "shuffled":
        rng.shuffle(rows)
    batches = [rows[i : i + 100] for i in range(0, 300, 100)]
    assert run(spark, tmp_path, batches) == want


def test_a_late_revert_leaves_the_download_behind_it(spark, tmp_path):
    batches = [[event(1, 1, "downloaded"), event(1, 5, "downloaded"), event(2, 1, "downloaded")],
               [event(1, 3, "reverted")], [event(2, 9, "reverted")]]
    assert run(spark, tmp_path, batches[:1]) == {"1": 10, "2": 10}
    assert run(spark, tmp_path, batches[1:2]) == {"1": 50, "2": 10}
    assert run(spark, tmp_path, batches[2:]) == {"1": 50}


def test_state_keeps_what_the_watermark_has_not_settled(spark, tmp_path):
    """Minutes 0 to 99 in batches of ten, five minutes late at most: repeats behind the watermark go."""
    batches = [[event(1, seq, "downloaded") for seq in range(a, a + 10)] for a in range(0, 50, 10)]
    assert run(spark, tmp_path, batches, "5 minutes") == {"1": 0}
    state = spark.read.format("statestore").option("stateVarName", "effect").load(f"{tmp_path}/cp")
    (held,) = [len(r.value.downloads) // 24 for r in state.collect()]
    assert held <= 21
    assert run(spark, tmp_path, [[event(1, 200, "reverted")], [event(1, 201, "downloaded")]], "5 minutes") == {"1": 2010}
