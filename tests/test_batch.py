import json
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagemill.constants import RECORD_SEPARATOR
from pagemill.functions.html import EXTRACT_TYPE, page_text
from pagemill.plans import batch as plan
from pagemill.plans.batch import FETCH_LOG_DDL, LEDGER_DDL, Layout
from pagemill.sources.warc import archive_listing
from pagemill.streaming import streams
from tests.archives import members, nested_archive, page, put, response, warcinfo

def AT():
    return F.lit(datetime(2024, 5, 1))



def landed(tmp_path) -> Layout:
    layout = Layout(str(tmp_path / "run"))
    put(layout.landing, "a.warc.gz", members(warcinfo(), *(response(page(i)) for i in range(30))))
    put(layout.landing, "short.warc.gz", members(*(response(page(i, 3)) for i in range(5))))
    put(layout.landing, "bad.warc.gz", members(*(response(page(i)) for i in range(9)))[:-40])
    put(
        layout.landing,
        "odd.warc.gz",
        members(response(page(50))) + nested_archive() + members(response(page(51))),
    )
    return layout


def text_of(*numbers: int) -> str:
    return "".join(page_text(page(i).decode())[0] + RECORD_SEPARATOR for i in numbers)


def ledger(spark, layout):
    return plan.read_table(spark, layout.ledger, LEDGER_DDL)


def corpus_text(layout, name: str) -> str:
    parts = sorted(
        Path(layout.corpus).glob(f"batch=*/attempt=*/basename={name}/chunk=*/part-*.txt"),
        key=lambda p: int(p.parent.name.split("=")[1]),
    )
    return "".join(p.read_text() for p in parts)


@pytest.mark.parametrize("split_bytes", [1500, 1 << 27])
def test_batch(spark, tmp_path, split_bytes):
    layout = landed(tmp_path)
    files = archive_listing(spark, layout.landing)
    counted = plan.run_batch(spark, files, layout, "one", split_bytes=split_bytes, span=2000, at=AT())
    assert counted == {"records": 32, "text_bytes": len(text_of(*range(30), 50, 51)), "errors": 1}
    sizes = {p.name: p.stat().st_size for p in Path(layout.landing).iterdir()}
    want_a, want_odd = text_of(*range(30)), text_of(50, 51)
    assert corpus_text(layout, "a.warc.gz") == want_a
    assert corpus_text(layout, "odd.warc.gz") == want_odd
    assert corpus_text(layout, "bad.warc.gz") == corpus_text(layout, "short.warc.gz") == ""
    rows = {r.basename: (*tuple(r)[1:6], r.batch) for r in ledger(spark, layout).collect()}
    when = datetime(2024, 5, 1)
    assert rows == {
        "a.warc.gz": (sizes["a.warc.gz"], 30, len(want_a), sizes["a.warc.gz"] - len(want_a), when, "one"),
        "odd.warc.gz": (sizes["odd.warc.gz"], 2, len(want_odd), sizes["odd.warc.gz"] - len(want_odd), when, "one"),
        "short.warc.gz": (sizes["short.warc.gz"], 0, 0, sizes["short.warc.gz"], when, "one"),
    }

    # the failed archive is tried again, the others are not
    put(layout.landing, "bad.warc.gz", members(*(response(page(i)) for i in range(9))))
    files = archive_listing(spark, layout.landing)
    plan.run_batch(spark, files, layout, "two", split_bytes=split_bytes, at=AT())
    assert {r.basename for r in ledger(spark, layout).where("batch = 'two'").collect()} == {"bad.warc.gz"}
    assert corpus_text(layout, "bad.warc.gz") == text_of(*range(9))
    assert plan.clean_corpus(spark, layout).count() == 41
    plan.run_batch(spark, files, layout, "three", at=AT())
    assert ledger(spark, layout).count() == 4

    # a batch that is repeated changes nothing
    before = sorted(map(tuple, ledger(spark, layout).collect()))
    plan.run_batch(spark, files, layout, "two", split_bytes=split_bytes, at=AT())
    assert sorted(map(tuple, ledger(spark, layout).collect())) == before
    assert plan.clean_corpus(spark, layout).count() == 41


def test_output_without_ledger_row_is_not_read_but_can_be_taken_over(spark, tmp_path):
    layout = landed(tmp_path)
    files = archive_listing(spark, layout.landing).where("basename = 'a.warc.gz'")
    plan.run_batch(spark, files, layout, "one")
    lost = Layout(layout.root + "/../run2")
    assert plan.corpus_outputs(spark, lost.corpus).count() == 0
    Path(layout.ledger).rename(tmp_path / "lost_ledger")
    assert plan.clean_corpus(spark, layout).count() == 0
    plan.run_batch(spark, files, layout, "two", skip_existing_outputs=True, at=AT())
    (row,) = ledger(spark, layout).collect()
    assert (row.basename, row.kept_records, row.removed_bytes) == ("a.warc.gz", None, 0)
    assert plan.clean_corpus(spark, layout).count() == 30


def test_repeat_with_missing_archives_keeps_what_was_done(spark, tmp_path):
    layout = landed(tmp_path)
    plan.run_batch(spark, archive_listing(spark, layout.landing), layout, "one", at=AT())
    before = sorted(map(tuple, ledger(spark, layout).collect()))
    Path(layout.landing).rename(tmp_path / "moved")
    put(layout.landing, "more.warc.gz", members(response(page(70))))
    plan.run_batch(spark, archive_listing(spark, layout.landing), layout, "one", at=AT())
    after = sorted(map(tuple, ledger(spark, layout).collect()))
    assert [r for r in after if r[0] != "more.warc.gz"] == before
    assert plan.clean_corpus(spark, layout).count() == 33


def test_repeat_after_a_stop_between_corpus_and_ledger(spark, tmp_path, monkeypatch):
    layout = landed(tmp_path)
    files = archive_listing(spark, layout.landing).where("basename = 'a.warc.gz'")

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(plan, "_append", stop)
        with pytest.raises(KeyboardInterrupt):
            plan.run_batch(spark, files, layout, "one")
    assert plan.clean_corpus(spark, layout).count() == 0
    plan.run_batch(spark, files, layout, "one")
    assert plan.clean_corpus(spark, layout).count() == 30


def test_nothing_kept_reads_as_no_rows(spark, tmp_path):
    layout = Layout(str(tmp_path))
    assert plan.clean_corpus(spark, layout).count() == 0
    put(layout.landing, "a.warc.gz", members(*(response(page(i, 3)) for i in range(5))))
    plan.run_batch(spark, archive_listing(spark, layout.landing), layout, "one")
    assert plan.clean_corpus(spark, layout).count() == 0
    assert ledger(spark, layout).first().kept_records == 0


def test_one_bad_archive_does_not_end_the_batch(spark, tmp_path):
    layout = Layout(str(tmp_path))
    bad = response(page(1)).replace(b"Content-Length: ", b"Content-Length: " + b"9" * 5000, 1)
    put(layout.landing, "bad.warc.gz", members(bad))
    put(layout.landing, "line.warc.gz", members(response(page(1)).replace(b"WARC-Type", b"X" * 2_000_000 + b": y\r\nWARC-Type", 1)))
    put(layout.landing, "good.warc.gz", members(response(page(2))))
    put(layout.landing, "plain.warc", response(page(3)))
    counted = plan.run_batch(spark, archive_listing(spark, layout.landing), layout, "one")
    assert (counted["records"], counted["errors"]) == (2, 2)
    assert {r.basename for r in ledger(spark, layout).collect()} == {"good.warc.gz", "plain.warc"}


def test_batches_at_once_count_an_archive_once(spark, tmp_path):
    layout = landed(tmp_path)
    files = archive_listing(spark, layout.landing)
    plan.run_batch(spark, files, layout, "one", at=AT())
    row = ledger(spark, layout).where("basename = 'a.warc.gz'")
    plan._append(row.withColumn("batch", F.lit("two")).withColumn("attempt", F.lit("z")), layout.ledger)
    assert plan.ledger_rows(spark, layout).count() == 3
    assert plan.clean_corpus(spark, layout).count() == 32


def test_many_records_in_one_member_stay_in_order(spark, tmp_path):
    layout = Layout(str(tmp_path))
    one = members(b"".join(response(page(i)) for i in range(300)))
    put(layout.landing, "a.warc.gz", one + members(response(page(301)), response(page(302))))
    plan.run_batch(spark, archive_listing(spark, layout.landing), layout, "one", span=len(one) // 3)
    assert corpus_text(layout, "a.warc.gz") == text_of(*range(300), 301, 302)
    chunks = plan.clean_corpus(spark, layout).select("chunk").distinct().count()
    assert chunks >= 1


def test_missing_archive_is_not_done(spark, tmp_path):
    layout = Layout(str(tmp_path))
    files = spark.createDataFrame([(str(tmp_path / "gone.gz"), 10)], "path STRING, length BIGINT")
    plan.run_batch(spark, files, layout, "one")
    assert ledger(spark, layout).count() == 0


def test_own_extractor(spark, tmp_path):
    layout = Layout(str(tmp_path))
    put(layout.landing, "a.warc.gz", members(response(page(1))))
    upper = lambda c: F.struct(
        F.upper(c.cast("string")).alias("text"), F.lit("own").alias("route"), F.lit(1).alias("n_segments")
    )
    plan.run_batch(spark, archive_listing(spark, layout.landing), layout, extractor=upper)
    assert plan.clean_corpus(spark, layout).first().value == page(1).decode().upper()


def test_fetch(spark, tmp_path):
    source = tmp_path / "source"
    for name in ("done.gz", "new.gz", "zero.gz", "large.gz", "gone.gz"):
        put(source / "dir", name, b"x" * 1000)
    layout = Layout(str(tmp_path / "run"))
    plan._append_batch(
        spark.createDataFrame(
            [("done.gz", 1, 1, 1, 0, datetime(2024, 1, 1), "x")], LEDGER_DDL.rsplit(",", 1)[0]
        ),
        layout.ledger,
        "old",
    )
    names = ["done.gz", "new.gz", "zero.gz", "large.gz", "gone.gz", "unlisted.gz", "unknown.gz"]
    manifest = spark.createDataFrame(
        [(f"dir/{n}", n) for n in names] + [("other/new.gz", "new.gz")], "rel_path STRING, basename STRING"
    )
    listing = spark.createDataFrame(
        [("done.gz", "9"), ("new.gz", "1000"), ("zero.gz", "0"), ("large.gz", "99999999999"),
         ("gone.gz", "5"), ("unknown.gz", "")],
        "basename STRING, content_length STRING",
    )
    (source / "dir" / "gone.gz").rename(tmp_path / "elsewhere")
    got = plan.run_fetch(spark, manifest, layout, "b", f"file:{source}/", listing, budget_bytes=10**9, tasks=3, at=AT())
    outcome = {r.basename: (r.status, r.bytes) for r in got.collect()}
    assert outcome == {
        "done.gz": ("skipped_cleaned", None), "new.gz": ("downloaded", 1000), "zero.gz": ("size_zero", None),
        "large.gz": ("no_capacity", None), "gone.gz": ("failed", None), "unlisted.gz": ("head_failed", None),
        "unknown.gz": ("failed", None),
    }
    assert [p.name for p in Path(layout.landing).iterdir()] == ["new.gz"]
    assert "FileNotFoundError" in got.where("basename = 'gone.gz'").first().error


def test_streams_equal_batch_and_state_export(spark, tmp_path):
    source = tmp_path / "source"
    for n in range(5):
        put(source, f"f{n}.warc.gz", members(*(response(page(100 * n + i)) for i in range(4))))
    (tmp_path / "manifests").mkdir()
    (tmp_path / "manifests" / "one.paths").write_text("# list\n" + "".join(f"f{n}.warc.gz\n" for n in range(5)))
    layout = Layout(str(tmp_path / "run"))
    fetching = streams.fetch_stream(spark, str(tmp_path / "manifests"), layout, f"file:{source}/")
    fetching.awaitTermination()
    cleaning = streams.clean_stream(spark, layout, files_per_batch=2)
    cleaning.awaitTermination()
    assert [p["numInputRows"] for p in cleaning.recentProgress if p["numInputRows"]] == [2, 2, 1]
    got = sorted((r.basename, r.value) for r in plan.clean_corpus(spark, layout).collect())

    alone = Layout(str(tmp_path / "alone"))
    plan.run_batch(spark, archive_listing(spark, str(source)), alone)
    assert got == sorted((r.basename, r.value) for r in plan.clean_corpus(spark, alone).collect())
    assert len(got) == 20

    # a second run finds nothing to do; a new checkpoint does not touch what is done
    streams.clean_stream(spark, layout, files_per_batch=2).awaitTermination()
    Path(layout.folder("checkpoints")).rename(tmp_path / "old_checkpoints")
    streams.clean_stream(spark, layout, files_per_batch=2).awaitTermination()
    assert ledger(spark, layout).count() == 5 and plan.clean_corpus(spark, layout).count() == 20

    totals = plan.totals(spark, layout).first()
    size = sum(p.stat().st_size for p in source.iterdir())
    assert totals.total_data_downloaded_bytes == size
    assert totals.total_warc_successfully_cleaned_count == totals.total_warc_processed_for_download_count == 5
    plan.export_state(spark, layout, str(tmp_path / "state"))
    (stats,) = (tmp_path / "state" / "stats").glob("document=*/*.txt")
    assert json.loads(stats.read_text())["total_data_downloaded_bytes"] == size
    (tracker,) = (tmp_path / "state" / "tracker").glob("document=*/*.txt")
    assert json.loads(tracker.read_text()) == {"cleaned_warc_basenames": [f"f{n}.warc.gz" for n in range(5)]}
    assert plan.read_table(spark, layout.fetch_log, FETCH_LOG_DDL).count() == 5


def test_source_is_removed_only_when_asked(spark, tmp_path):
    layout = Layout(str(tmp_path / "run"))
    for n in range(3):
        put(layout.landing, f"f{n}.gz", members(response(page(n))))
    streams.clean_stream(spark, layout, files_per_batch=1, clean_source="delete").awaitTermination()
    left = {p.name for p in Path(layout.landing).iterdir()}
    assert len(left) < 3  # those of the last batch stay until the next one
    assert ledger(spark, layout).count() == 3


def test_active_worker_stream(spark, tmp_path):
    from pagemill.operators.activity import active_workers

    rows = [(w, s, f"f{s}", "start" if (w + s) % 3 else "end") for w in range(6) for s in range(9)]
    ddl = "worker BIGINT, seq BIGINT, filename STRING, status STRING"
    messages = spark.createDataFrame(rows, ddl)
    messages.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in"))
    streams.active_worker_stream(stream, str(tmp_path / "view"), str(tmp_path / "cp"), 3).awaitTermination()
    got = streams.active_view(spark, str(tmp_path / "view"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, active_workers(messages, 3).collect()))


def test_run_to_end(spark, tmp_path):
    from pagemill.plans.run import run_to_end

    source = tmp_path / "source"
    for n in range(4):
        put(source, f"f{n}.warc.gz", members(*(response(page(100 * n + i)) for i in range(3))))
    (tmp_path / "manifests").mkdir()
    (tmp_path / "manifests" / "one.paths").write_text("".join(f"f{n}.warc.gz\n" for n in range(4)))
    layout = Layout(str(tmp_path / "run"))
    for _ in range(2):  # a second run finds nothing to do
        row = run_to_end(spark, str(tmp_path / "manifests"), layout, f"file:{source}/").first()
        assert row.total_warc_successfully_cleaned_count == ledger(spark, layout).count() == 4
        assert plan.clean_corpus(spark, layout).count() == 12
    (tracker,) = Path(layout.folder("state/tracker")).glob("document=*/*.txt")
    assert len(json.loads(tracker.read_text())["cleaned_warc_basenames"]) == 4


def test_counters_of_batches_equal_totals(spark, tmp_path):
    source = tmp_path / "source"
    for n in range(5):
        put(source, f"f{n}.gz", members(*(response(page(100 * n + i)) for i in range(4))))
    put(source, "bad.gz", members(response(page(1)))[:-9])
    (tmp_path / "manifests").mkdir()
    (tmp_path / "manifests" / "one").write_text("".join(f"f{n}.gz\n" for n in range(5)) + "bad.gz\n")
    layout = Layout(str(tmp_path / "run"))
    assert plan.totals_of_batches(spark, layout).first() == plan.totals(spark, layout).first()
    streams.fetch_stream(spark, str(tmp_path / "manifests"), layout, f"file:{source}/").awaitTermination()
    streams.clean_stream(spark, layout, files_per_batch=2).awaitTermination()
    assert plan.totals_of_batches(spark, layout).first() == plan.totals(spark, layout).first()
    rows = plan.batch_counters(spark, layout)
    # every batch that cleaned something has a row; the bad archive counts for none
    assert rows.where("attempt <> 'copies'").agg(F.sum("cleaned_files")).first()[0] == 5
    assert rows.where("attempt = 'copies'").first().downloaded_files == 6

    # copies that come again and batches that are repeated add nothing
    manifest = spark.createDataFrame([("f1.gz", "f1.gz"), ("bad.gz", "bad.gz")], "rel_path STRING, basename STRING")
    for _ in range(2):
        plan.run_fetch(spark, manifest, layout, "more", f"file:{source}/")
        plan.run_batch(spark, archive_listing(spark, layout.landing), layout, "more")
    assert plan.totals_of_batches(spark, layout).first() == plan.totals(spark, layout).first()


def test_counters_of_a_stopped_attempt_do_not_count(spark, tmp_path, monkeypatch):
    layout = Layout(str(tmp_path))
    put(layout.landing, "a.gz", members(response(page(1))))
    files = archive_listing(spark, layout.landing)
    append = plan._append

    def stop(table, folder):
        if folder == layout.ledger:
            raise KeyboardInterrupt
        append(table, folder)

    with monkeypatch.context() as m:
        m.setattr(plan, "_append", stop)
        with pytest.raises(KeyboardInterrupt):
            plan.run_batch(spark, files, layout, "one")
    assert plan.totals_of_batches(spark, layout).first().total_warc_successfully_cleaned_count == 0
    for _ in range(2):
        plan.run_batch(spark, files, layout, "one")
    assert plan.totals_of_batches(spark, layout).first() == plan.totals(spark, layout).first()


def test_lost_ledger_is_written_anew(spark, tmp_path):
    layout = landed(tmp_path)
    files = archive_listing(spark, layout.landing)
    assert plan.recover_ledger(spark, layout) == 0  # no outputs yet
    plan.run_batch(spark, files, layout, "one", at=AT())
    assert plan.recover_ledger(spark, layout, AT()) == 0  # a ledger is there
    texts = sorted(map(tuple, plan.clean_corpus(spark, layout).collect()))
    Path(layout.ledger).rename(tmp_path / "lost")
    assert plan.recover_ledger(spark, layout, AT()) == 2
    rows = {r.basename: (r.kept_records, r.removed_bytes, r.batch) for r in ledger(spark, layout).collect()}
    assert rows == {"a.warc.gz": (None, 0, "one"), "odd.warc.gz": (None, 0, "one")}
    assert sorted(map(tuple, plan.clean_corpus(spark, layout).collect())) == texts
    counted = plan.run_batch(spark, files, layout, "two", at=AT())
    assert counted["records"] == 0  # only the archives without an output come again
    assert {r.basename for r in ledger(spark, layout).where("batch = 'two'").collect()} == {"short.warc.gz"}


def test_extraction_takes_pages_in_batches_of_bounded_size(spark, tmp_path):
    layout = Layout(str(tmp_path / "run"))
    big = [response(b"<html><body>" + b"%d" % i * 500_000 + b"</body></html>") for i in range(40, 80)]
    put(layout.landing, "big.warc.gz", members(*big))

    @F.arrow_udf(EXTRACT_TYPE)
    def batch_size(pages: pa.Array) -> pa.Array:
        n = len(pages)
        columns = [pa.array([f"{n} pages"] * n), pa.array(["own"] * n), pa.array([1] * n, pa.int32())]
        return pa.StructArray.from_arrays(columns, names=["text", "route", "n_segments"])

    files = archive_listing(spark, layout.landing)
    own = batch_size.asNondeterministic()
    assert plan.run_batch(spark, files, layout, "one", min_len=1, extractor=own)["records"] == 40
    sizes = [int(r.value.split()[0]) for r in plan.clean_corpus(spark, layout).collect()]
    assert len(sizes) == 40 and max(sizes) <= 18  # of a megabyte each
