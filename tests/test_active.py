import random

from pyspark.sql import functions as F

from pagemill.operators.activity import active_workers
from pagemill.streaming import streams

DDL = "worker BIGINT, seq BIGINT, filename STRING, status STRING"


def run(spark, tmp_path, batches) -> set[tuple]:
    """Each list of messages is a file, and so a batch; the view afterwards."""
    for rows in batches:
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    query = streams.active_worker_stream(stream, str(tmp_path / "view"), str(tmp_path / "cp"), 3)
    assert query.awaitTermination(100)
    return {tuple(r) for r in streams.active_view(spark, str(tmp_path / "view")).collect()}


def state(spark, tmp_path, variable="active") -> int:
    reader = spark.read.format("statestore").option("stateVarName", variable)
    return reader.load(str(tmp_path / "cp")).count()


def test_state_is_one_row_an_active_worker(spark, tmp_path):
    rng = random.Random(4)
    rows = [
        (rng.randrange(40), seq, f"f{seq}", rng.choice(["start", "end"])) for seq in range(400)
    ]
    rng.shuffle(rows)  # late messages: the largest seq decides
    parts = [rows[i::4] for i in range(4)]
    for known in (2, 4):  # a second run goes on with the state of the first
        got = run(spark, tmp_path, parts[known - 2 : known])
        seen = spark.createDataFrame([r for p in parts[:known] for r in p], DDL)
        want = {tuple(r) for r in active_workers(seen, 3).collect()}
        assert got == want and 0 < len(want) < 40
        assert state(spark, tmp_path) == len(want)


def test_all_ended(spark, tmp_path):
    got = run(spark, tmp_path, [[(1, 1, "a", "start"), (2, 2, "b", "start")], [(1, 3, "a", "end"), (2, 4, "b", "end")]])
    assert got == set() and state(spark, tmp_path) == 0
    assert run(spark, tmp_path, [[(2, 1, "late", "start"), (3, 5, None, "start")]]) == {(3, "N1", None)}


def test_readers_see_one_version_or_the_next(spark, tmp_path):
    assert streams.active_view(spark, str(tmp_path / "view")).count() == 0
    run(spark, tmp_path, [[(1, 1, "a", "start")]])
    held = streams.active_view(spark, str(tmp_path / "view"))
    run(spark, tmp_path, [[(2, 2, "b", "start")], [(1, 3, "a", "end")]])
    assert [r.worker for r in held.collect()] == [1]  # its place is not the one that was written
    assert [r.worker for r in streams.active_view(spark, str(tmp_path / "view")).collect()] == [2]


def test_settings_of_the_session_stay(spark, tmp_path):
    before = [spark.conf.get(key, None) for key in streams._STATE_SETTINGS]
    run(spark, tmp_path, [[(1, 1, "a", "start")]])
    assert [spark.conf.get(key, None) for key in streams._STATE_SETTINGS] == before
    assert streams.active_view(spark, str(tmp_path / "view")).where(F.col("worker") == 1).count() == 1
