import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pagemill.constants import RECORD_SEPARATOR
from pagemill.operators import activity, corpus, ledger, manifest
from pagemill.operators.records import clean_pages, html_records
from pagemill.plans import queries
from pagemill.sources import state_json


def frame(spark, ddl, *rows):
    return spark.createDataFrame(list(rows), ddl)


# ---- manifest ----


def test_manifest_file(spark, tmp_path):
    lines = "a/one.gz\r\n\n#skip\n  #kept\n\t b/two.gz  \n   \nc/dir/\rb/one.gz"
    (tmp_path / "warc.paths").write_bytes(lines.encode())
    got = manifest.read_manifest(spark, str(tmp_path / "warc.paths"), "base/")
    assert sorted(map(tuple, got.collect())) == sorted(
        [
            ("a/one.gz", "one.gz", "base/a/one.gz"),
            ("#kept", "#kept", "base/#kept"),
            ("b/two.gz", "two.gz", "base/b/two.gz"),
            ("c/dir/", "dir", "base/c/dir/"),
            ("b/one.gz", "one.gz", "base/b/one.gz"),
        ]
    )
    one = manifest.one_path_per_basename(got).where("basename = 'one.gz'").collect()
    assert [tuple(r) for r in one] == [("one.gz", "a/one.gz")]


def test_missing_or_empty_manifest(spark, tmp_path):
    assert manifest.read_manifest(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "empty").write_text("# nothing\n\n")
    assert manifest.read_manifest(spark, str(tmp_path / "empty")).count() == 0


def test_skip_cleaned_keeps_nulls_apart(spark):
    wanted = frame(spark, "basename STRING", ("a",), ("b",), ("b",), (None,))
    done = frame(spark, "basename STRING", ("a",), (None,))
    assert [r[0] for r in manifest.skip_cleaned(wanted, done).orderBy("basename").collect()] == [None, "b", "b"]


def test_sizes(spark):
    wanted = frame(spark, "basename STRING", ("a",), ("b",), ("c",), ("d",), ("e",))
    listing = frame(
        spark, "basename STRING, content_length STRING", ("a", "0"), ("b", None), ("c", "100"), ("d", "91")
    )
    got = manifest.with_sizes(wanted, listing).select(
        "basename", manifest.size_status("content_length", 100, F.col("found"))
    )
    assert dict(map(tuple, got.collect())) == {
        "a": "size_zero", "b": "no_capacity", "c": "no_capacity", "d": None, "e": "head_failed",
    }


# ---- records ----


def test_html_filter(spark):
    rows = [
        ("response", "text/html", {"a": "b"}), ("resource", "application/xhtml+xml", {}),
        ("request", "text/html", {}), ("response", "text/HTML", {}), ("response", None, {}),
        ("response", "text/html", None),
    ]
    got = frame(spark, "rec_type STRING, content_type STRING, http_headers MAP<STRING,STRING>", *rows)
    assert html_records(got, "http_headers").count() == 2
    assert html_records(got).count() == 3


def test_length_filter_counts_code_points(spark):
    pages = frame(spark, "id INT, payload STRING", (1, "😀" * 99), (2, "😀" * 100), (3, "a  " * 40 + "b"), (4, None))
    got = clean_pages(pages).select("id", "route", F.length("text"))
    assert [tuple(r) for r in got.collect()] == [(2, "body", 100)]
    own = clean_pages(
        pages,
        min_len=1,
        extractor=lambda c: F.struct(F.lit("x").alias("text"), F.lit("own").alias("route"), F.lit(1).alias("n_segments")),
    )
    assert own.where("route = 'own'").count() == 4


# ---- corpus ----


def corpus_rows(n):
    pick = random.Random(11)
    rows = [(f"f{i % 3}" if i % 4 else "hot name+%.gz", i * 10, f"text {i} é " + "x" * pick.randrange(50)) for i in range(n)]
    pick.shuffle(rows)
    return rows


def test_corpus_files(spark, tmp_path):
    rows = corpus_rows(500)
    clean = frame(spark, "basename STRING, rec_offset BIGINT, text STRING", *rows).repartition(7)
    corpus.write_corpus(clean, str(tmp_path), span=1000)
    per_file = defaultdict(list)
    for name, offset, text in sorted(rows, key=lambda r: r[1]):
        per_file[name].append(text)
    for name, texts in per_file.items():
        escaped = name.replace("%", "%25")
        folder = tmp_path / f"basename={escaped}"
        chunks = sorted(folder.glob("chunk=*"), key=lambda p: int(p.name.split("=")[1]))
        assert len(chunks) == 5
        parts = [list(c.glob("part-*.txt")) for c in chunks]
        assert all(len(p) == 1 for p in parts)
        written = b"".join(p[0].read_bytes() for p in parts)
        assert written == "".join(t + RECORD_SEPARATOR for t in texts).encode()
    back = corpus.read_corpus(spark, str(tmp_path))
    assert sorted((r.basename, r.value) for r in back.collect()) == sorted((n, t) for n, _, t in rows)
    # writing one archive again replaces it and leaves the others
    again = frame(spark, "basename STRING, rec_offset BIGINT, text STRING", ("f1", 5, "new"))
    corpus.write_corpus(again, str(tmp_path), span=10**6)
    assert corpus.read_corpus(spark, str(tmp_path)).where("basename = 'f0'").count() > 0


def test_pack(spark):
    rows = [("k", i, f"t{i}") for i in range(10)] + [("l", 3, None), ("l", 4, "x")]
    got = corpus.pack_text(frame(spark, "k STRING, p INT, t STRING", *rows), "k", "p", "t", 4, "|")
    assert sorted(map(tuple, got.where("k = 'k'").collect())) == [
        ("k", 0, 4, "t0|t1|t2|t3|"), ("k", 1, 4, "t4|t5|t6|t7|"), ("k", 2, 2, "t8|t9|"),
    ]


def test_metrics(spark):
    files = frame(spark, "basename STRING, length BIGINT", ("a", 100), ("b", 5), ("c", 7))
    clean = frame(spark, "basename STRING, text STRING", ("a", "é"), ("a", "xyz"), ("b", "12345"))
    assert sorted(map(tuple, corpus.file_metrics(files, clean).collect())) == [
        ("a", 100, 2, 47, 53), ("b", 5, 1, 26, -21), ("c", 7, 0, 0, 7),
    ]


def test_finished_outputs(spark):
    files = frame(spark, "basename STRING, length BIGINT", ("a", 1), ("b", 1), ("c", 1))
    outputs = frame(spark, "basename STRING, length BIGINT", ("a", 100), ("b", 101))
    assert [r.basename for r in corpus.finished_outputs(files, outputs).collect()] == ["b"]


def test_list_outputs(spark, tmp_path):
    (tmp_path / "a.gz.txt").write_text("x" * 7)
    (tmp_path / "a.txt.txt").write_text("y")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "other.json").write_text("{}")
    got = corpus.list_outputs(spark, str(tmp_path))
    assert sorted(r.length for r in got.collect()) == [1, 7]
    from pagemill.plans.batch import rebuild_ledger

    known = frame(spark, "basename STRING", ("z",), ("a.gz",))
    assert [r[0] for r in rebuild_ledger(got, known).collect()] == ["a.gz", "a.txt", "z"]


# ---- ledger ----


def test_insert_absent(spark):
    have = frame(spark, "k STRING", ("a",))
    new = frame(spark, "k STRING, v INT, w STRING", ("a", 1, "x"), ("b", 2, "y"), ("b", 1, "z"), ("c", None, None))
    assert sorted(map(tuple, ledger.insert_absent(have, new, "k").collect())) == [("b", 1, "z"), ("c", None, None)]
    assert ledger.insert_absent(have, new.select("k"), "k").count() == 2


def test_updates(spark):
    now = frame(spark, "k STRING, n BIGINT", ("a", 1), ("b", None))
    delta = frame(spark, "k STRING, n BIGINT", ("a", 5), ("a", -2), ("c", 7))
    assert sorted(map(tuple, ledger.add_deltas(now, delta, "k", ["n"]).collect())) == [("a", 4), ("b", 0), ("c", 7)]
    changes = frame(spark, "k STRING, s INT, v STRING", ("a", 2, "new"), ("a", 1, "old"))
    assert [tuple(r) for r in ledger.set_latest(changes, "k", "s", ["v"]).collect()] == [("a", "new")]
    got = ledger.lookup(frame(spark, "k STRING", ("a",), ("x",)), now, "k", {"n": 9})
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("x", 9)]


def test_removed(spark):
    changes = frame(spark, "k STRING, s INT, gone BOOLEAN", ("a", 1, False), ("a", 2, True), ("b", 2, True), ("b", 3, False))
    assert [r[0] for r in ledger.without_removed(changes, "k", "s", F.col("gone")).collect()] == ["b"]


@pytest.mark.parametrize("span", [1, 7, 4096])
def test_downloads_in_effect(spark, span):
    pick = random.Random(span)
    # one key holds a third of all events
    rows = [(i, "hot" if i % 3 == 0 else f"k{pick.randrange(40)}", pick.choice("ddrx"), pick.randrange(1000)) for i in range(2000)]
    expected, held = {}, {}
    for _, key, kind, amount in rows:
        if kind == "d":
            held.setdefault(key, amount)
        elif kind == "r":
            held.pop(key, None)
    expected = held
    shuffled = rows[:]
    pick.shuffle(shuffled)
    events = frame(spark, "seq BIGINT, k STRING, kind STRING, bytes BIGINT", *shuffled).repartition(5)
    got = ledger.downloads_in_effect(
        events, "k", "seq", "bytes", F.col("kind") == "d", F.col("kind") == "r", span
    )
    assert dict(map(tuple, got.collect())) == expected


def test_totals_and_summary(spark):
    t = [datetime(2024, 1, 1, 0, 0, s) for s in range(5)]
    down = frame(spark, "basename STRING, bytes BIGINT, at TIMESTAMP", ("a", 2**30, t[1]), ("a", 2**30, t[2]), ("b", 2**29, t[3]))
    done = frame(spark, "basename STRING, removed_bytes BIGINT, at TIMESTAMP", ("a", -5, t[0]), ("a", -5, t[4]))
    totals = ledger.run_totals(down, done)
    assert tuple(totals.first()) == (2**30 + 2**29, -5, 2, 1, t[0], t[4])
    now = F.lit(datetime(2024, 1, 2, 1, 2, 3))
    assert dict(map(tuple, ledger.run_summary(totals, now).collect())) == {
        "Elapsed Time": "1 day, 1:02:03",
        "Data Downloaded": "1.50 GB",
        "Data Removed (Est.)": "-0.00 GB",
        "WARCs Downloaded": "2",
        "WARCs Cleaned": "1",
    }
    nothing = ledger.run_totals(down.limit(0), done.limit(0)).first()
    assert tuple(nothing) == (0, 0, 0, 0, None, None)


def test_distinct_names(spark):
    a, b = frame(spark, "basename STRING", ("b",), ("a",)), frame(spark, "basename STRING", ("a",), ("c",))
    assert [r[0] for r in ledger.distinct_names(a, b).collect()] == ["a", "b", "c"]


# ---- activity ----


def test_active_workers(spark):
    rows = [(1, 1, "f1", "start"), (1, 2, "f1", "end"), (1, 3, "f2", "start"), (2, 1, "g", "start"),
            (2, 2, "h", "start"), (3, 1, "x", "end"), (4, 5, "y", "end"), (4, 4, "y", "start")]
    got = activity.active_workers(frame(spark, "worker BIGINT, seq BIGINT, filename STRING, status STRING", *rows), 2)
    assert sorted(map(tuple, got.collect())) == [(1, "N0", "f2"), (2, "N1", "h")]


# ---- state documents ----


def test_state_documents(spark, tmp_path):
    names = frame(spark, "basename STRING", *((f"n{i:03d}",) for i in range(250)), ("n000",))
    folder = str(tmp_path / "tracker")
    state_json.write_state_json(state_json.name_documents(names, per_document=100), folder)
    documents = state_json.read_state_json(spark, folder, state_json.TRACKER_SCHEMA, state_json.tracker_defaults())
    assert documents.count() == 3
    assert [r[0] for r in state_json.tracked_names(documents).orderBy("basename").collect()] == [f"n{i:03d}" for i in range(250)]
    (text,) = [p.read_text() for p in (tmp_path / "tracker").glob("document=*/*.txt")][:1]
    assert text.startswith('{\n  "cleaned_warc_basenames" : [')


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"cleaned_warc_basenames": ["a", "b"]}', ["a", "b"]),
        ('{"cleaned_warc_basenames": []}', []),
        ("{}", []),
        ("{ broken", []),
        ('{"cleaned_warc_basenames": "not a list"}', []),
    ],
)
def test_tracker_defaults(spark, tmp_path, body, expected):
    (tmp_path / "t.json").write_text(body)
    got = state_json.read_state_json(
        spark, str(tmp_path / "t.json"), state_json.TRACKER_SCHEMA, state_json.tracker_defaults()
    )
    assert [r[0] for r in got.collect()] == [expected]


def test_stats_defaults(spark, tmp_path):
    (tmp_path / "s.json").write_text('{\n "total_data_downloaded_bytes": 5,\n "start_time_iso": "2024-01-01T00:00:00"\n}')
    now = F.lit("2025-01-01T00:00:00")
    got = state_json.read_state_json(
        spark, str(tmp_path / "s.json"), state_json.STATS_SCHEMA, state_json.stats_defaults(now)
    )
    assert tuple(got.first()) == (5, 0, 0, 0, "2024-01-01T00:00:00", "2025-01-01T00:00:00", [])


def test_documents_share_files(spark, tmp_path):
    texts = frame(
        spark, "value STRING",
        *((f'{{\n "cleaned_warc_basenames" :\n ["n{i}"]}}',) for i in range(300)), ("{ broken",), ("{}",), (None,),
    ).coalesce(2)
    folder = tmp_path / "documents"
    state_json.write_documents(texts, str(folder))
    assert len(list(folder.glob("*.txt"))) == 2
    got = state_json.read_state_json(
        spark, str(folder), state_json.TRACKER_SCHEMA, state_json.tracker_defaults(), many_per_file=True
    )
    assert sorted(r[0] for r in got.collect()) == sorted([["n%d" % i] for i in range(300)] + [[], []])


def test_state_defaults_makes_no_file_a_supplier(spark, tmp_path, monkeypatch):
    keys = [(i,) for i in range(400)] + [(3,), (None,)]  # a document a key, none without
    frame(spark, "s_suppkey BIGINT", *keys).coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, purpose: str(tmp_path / purpose))
    rows = [tuple(r) for r in queries.state_defaults(spark, str(tmp_path)).collect()]
    names = ("a,b", "nobody", "", "nobody")
    wanted = [(i if i % 4 < 2 else -1, names[i % 4]) for i in range(400)]
    assert sorted(rows) == sorted(wanted)
    assert len(list((tmp_path / "state").rglob("*.txt"))) < 20
