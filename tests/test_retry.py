from datetime import datetime, timedelta, timezone
from pathlib import Path

from pyspark.sql import functions as F

from pagemill.operators.retries import Retry, due, failure_state
from pagemill.plans import batch as plan
from pagemill.plans.batch import LEDGER_DDL, Layout
from pagemill.plans.retry import failures, retry_table, run_retries
from pagemill.plans.run import run_to_end
from pagemill.streaming import streams
from tests.archives import members, page, put, response

GOOD = members(*(response(page(i)) for i in range(4)))


def manifest(tmp_path, *names: str) -> str:
    (tmp_path / "manifests").mkdir()
    (tmp_path / "manifests" / "one.paths").write_text("".join(f"{n}\n" for n in names))
    return str(tmp_path / "manifests")


def done(spark, layout) -> set[str]:
    return {r.basename for r in plan.read_table(spark, layout.ledger, LEDGER_DDL).collect()}


def test_bad_and_late_archives_come_again(spark, tmp_path):
    source, layout = tmp_path / "source", Layout(str(tmp_path / "run"))
    put(source, "good.gz", GOOD)
    put(source, "cut.gz", GOOD[:-40])
    run = lambda: run_to_end(spark, listed, layout, f"file:{source}/")
    listed = manifest(tmp_path, "good.gz", "cut.gz", "late.gz")
    run()
    assert done(spark, layout) == {"good.gz"}
    state = {r.basename: (r.attempts, r.set_apart) for r in retry_table(spark, layout).collect()}
    assert state == {"cut.gz": (1, False), "late.gz": (1, False)}
    put(source, "cut.gz", GOOD)
    put(source, "late.gz", GOOD)
    row = run().first()
    assert done(spark, layout) == {"good.gz", "cut.gz", "late.gz"}
    assert plan.clean_corpus(spark, layout).count() == 12
    assert row.total_warc_successfully_cleaned_count == row.total_warc_processed_for_download_count == 3
    assert retry_table(spark, layout).count() == 0
    run()
    assert plan.read_table(spark, layout.ledger, LEDGER_DDL).count() == 3


def test_what_stays_bad_is_set_apart(spark, tmp_path):
    source, layout = tmp_path / "source", Layout(str(tmp_path / "run"))
    put(source, "good.gz", GOOD)
    put(source, "cut.gz", GOOD[:-40])
    listed = manifest(tmp_path, "good.gz", "cut.gz", "absent.gz")
    for attempts in (1, 2, 3, 3):
        run_to_end(spark, listed, layout, f"file:{source}/", policy=Retry(attempts=3))
        state = {r.basename: (r.attempts, r.set_apart) for r in retry_table(spark, layout, Retry(3)).collect()}
        assert state == {n: (attempts, attempts == 3) for n in ("cut.gz", "absent.gz")}
    reasons = {r.basename: r.reason for r in retry_table(spark, layout).collect()}
    assert reasons["absent.gz"] == "head_failed" and "Error" in reasons["cut.gz"]
    # another policy takes them up again
    put(source, "absent.gz", GOOD)
    run_to_end(spark, listed, layout, f"file:{source}/", policy=Retry(attempts=9))
    assert done(spark, layout) == {"good.gz", "absent.gz"}


def test_archives_no_manifest_lists_are_read_again_in_place(spark, tmp_path):
    layout = Layout(str(tmp_path / "run"))
    put(layout.landing, "cut.gz", GOOD[:-40])
    streams.clean_stream(spark, layout).awaitTermination()
    put(layout.landing, "cut.gz", GOOD)
    streams.clean_stream(spark, layout).awaitTermination()
    assert done(spark, layout) == set()  # the file source has seen it
    again = lambda **more: streams.retry_stream(spark, str(tmp_path / "none"), layout, **more)
    before = datetime.now(timezone.utc) - timedelta(hours=1)
    again(started=before).awaitTermination()  # it failed in this run, and the pause is not over
    assert done(spark, layout) == set()
    again(started=before, policy=Retry(first_pause=0)).awaitTermination()
    assert done(spark, layout) == {"cut.gz"}


def test_a_repeated_batch_counts_a_failure_once(spark, tmp_path):
    layout = Layout(str(tmp_path / "run"))
    put(layout.landing, "cut.gz", GOOD[:-40])
    nothing = spark.createDataFrame([], "rel_path STRING, basename STRING")
    plan.run_batch(spark, plan_files(spark, layout), layout, "one")
    for _ in range(2):
        run_retries(spark, nothing, layout, F.current_timestamp(), batch="two")
    assert retry_table(spark, layout).first().attempts == 2
    assert failures(spark, layout).count() == 2


def plan_files(spark, layout):
    from pagemill.sources.warc import archive_listing

    return archive_listing(spark, layout.landing)


def test_nothing_due_does_nothing(spark, tmp_path):
    layout = Layout(str(tmp_path / "run"))
    nothing = spark.createDataFrame([], "rel_path STRING, basename STRING")
    counted = run_retries(spark, nothing, layout, F.current_timestamp())
    assert counted == {"records": 0, "text_bytes": 0, "errors": 0}
    assert not Path(layout.corpus).exists()


def test_state_and_due(spark):
    at = lambda s: datetime(2024, 5, 1) + timedelta(seconds=s)
    rows = [
        ("once", "a", True, at(0)),
        ("thrice", "a", True, at(0)), ("thrice", "b", True, at(9)), ("thrice", "c", True, at(5)),
        ("size", "size_zero", False, at(0)), ("size", "size_zero", False, at(1)),
        ("long", "x", True, at(0)), *[("long", "y", True, at(1))] * 19,
    ]
    frame = spark.createDataFrame(rows, "basename STRING, reason STRING, counts BOOLEAN, at TIMESTAMP")
    policy = Retry(attempts=20, first_pause=10, longest_pause=100)
    state = failure_state(frame, policy)
    got = {r.basename: (r.attempts, r.reason, r.next_due - r.last_at, r.set_apart) for r in state.collect()}
    pause = lambda s: timedelta(seconds=s)
    assert got == {
        "once": (1, "a", pause(10), False),
        "thrice": (3, "b", pause(40), False),
        "size": (0, "size_zero", pause(10), False),
        "long": (20, "y", pause(100), True),
    }
    names = lambda now, since: {r.basename for r in due(state, F.lit(at(now)), F.lit(at(since))).collect()}
    assert names(5, -1) == set()
    assert names(12, -1) == {"once", "size"}
    assert names(5, 1) == {"once"}
    assert names(999, -1) == {"once", "size", "thrice"}
