import gzip
import io
import zlib

import pytest
from pyspark.sql import functions as F

from pagemill.sources.archive_reader import ArchiveError, read_range
from pagemill.sources.warc import archive_listing, broken_splits, records, register, scan_archives
from tests.archives import HTML, members, nested_archive, page, put, response, warc_record, warcinfo


def read(data: bytes, start=0, end=None, html_only=False, **options):
    return list(read_range(io.BytesIO(data), start, end, html_only, **options))


def payloads(data: bytes, **options):
    return [r[5] for r in read(data, **options) if r[0] == "record"]


def in_ranges(data: bytes, step: int):
    rows, marks = [], []
    for start in range(0, len(data), step):
        try:
            for r in read_range(io.BytesIO(data), start, start + step, False):
                (rows if r[0] == "record" else marks).append(r)
        except ArchiveError as e:
            marks.append(("error", None, None, str(e)))
    return rows, marks


@pytest.mark.parametrize("zipped", [True, False])
def test_records_in_order(zipped):
    parts = [warcinfo(), response(page(1)), response(page(2), {"content-TYPE": "text/html;x"})]
    rows = read(members(*parts) if zipped else b"".join(parts))
    assert [r[2] for r in rows[:-1]] == ["warcinfo", "response", "response"]
    assert [r[3] for r in rows[:-1]] == [None, "text/html", "text/html;x"]
    assert [r[5] for r in rows[1:-1]] == [page(1), page(2)]
    assert rows[0][4] is None and rows[0][5] == b"software: test\r\n"
    offsets = [r[1] for r in rows[:-1]]
    assert offsets == sorted(set(offsets)) and rows[-1] == ("split", 0, None)


@pytest.mark.parametrize("zipped", [True, False])
@pytest.mark.parametrize("step", [50, 333, 1000, 4096, 10**6])
def test_ranges_add_up(zipped, step):
    parts = [warcinfo()] + [response(page(i, i % 70)) for i in range(60)]
    data = members(*parts) if zipped else b"".join(parts)
    rows, marks = in_ranges(data, step)
    assert rows == read(data)[:-1]
    started = sorted(m[1] for m in marks if m[1])
    stopped = sorted(m[2] for m in marks if m[2] is not None)
    assert started == stopped


def test_a_look_alike_start_shows():
    data = members(*(response(page(i)) for i in range(5))) + nested_archive() + members(response(page(9)))
    whole = read(data)[:-1]
    assert len(whole) == 7
    rows, marks = in_ranges(data, 2000)
    assert len(rows) > 7  # records of the nested archive were taken for real ones
    assert sorted(m[1] for m in marks if m[1]) != sorted(m[2] for m in marks if m[2] is not None)


def test_members_with_several_records_and_records_over_members():
    one = gzip.compress(b"".join(response(page(i)) for i in range(5)))
    rows = read(one)[:-1]
    assert [r[5] for r in rows] == [page(i) for i in range(5)]
    assert len({(r[1], r[6]) for r in rows}) == 5
    text = b"".join(response(page(i)) for i in range(5))
    cut = b"".join(gzip.compress(text[i : i + 100]) for i in range(0, len(text), 100))
    assert [r[5] for r in read(cut)[:-1]] == [page(i) for i in range(5)]


def test_html_only():
    parts = [
        warcinfo(),
        response(page(1)),
        response(page(2), {"Content-Type": "text/HTML"}),
        response(page(3), {"Content-Type": "application/xhtml+xml"}),
        response(page(4), {}),
        response(page(5), {"Content-Type": "text/plain"}),
        warc_record("request", "http://x/", b"GET / HTTP/1.1\r\nContent-Type: text/html\r\n\r\n", "application/http"),
        warc_record("resource", "http://x/", page(6), "text/html"),
        warc_record("response", "http://x/", b"", "application/http"),
    ]
    assert payloads(members(*parts), html_only=True) == [page(1), page(3)]
    assert len(payloads(members(*parts))) == len(parts)
    assert payloads(members(*parts), html_only=True, with_payload=False) == [None, None]


def chunked(body: bytes, size: int = 7) -> bytes:
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    return b"".join(b"%x;ext=1\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


@pytest.mark.parametrize(
    "headers, body",
    [
        ({"Transfer-Encoding": "chunked"}, chunked(page(1))),
        ({"Transfer-Encoding": "chunked"}, page(1)),
        ({"Content-Encoding": "gzip"}, gzip.compress(page(1))),
        ({"Content-Encoding": "gzip"}, page(1)),
        ({"Content-Encoding": "deflate"}, zlib.compress(page(1))),
        ({"Content-Encoding": "deflate"}, zlib.compress(page(1), wbits=-15)),
        ({"Content-Encoding": "gzip", "Transfer-Encoding": "Chunked"}, chunked(gzip.compress(page(1)))),
        ({"Content-Encoding": "identity"}, page(1)),
    ],
)
def test_transfer_and_content_encodings(headers, body):
    assert payloads(members(response(body, HTML | headers))) == [page(1)]


def test_header_details():
    block = b"HTTP/1.1 200 OK\nX-A: one\n two\nx-a: second\nContent-Type:text/html\nbroken line\n\nbody"
    (record, _) = read(members(warc_record("response", "http://x/", block, "application/http")))
    assert record[4] == {"x-a": "one two", "content-type": "text/html"} and record[5] == b"body"


def test_responses_that_are_not_http():
    block = b"20240101000000\nx.example. 300 IN A 127.0.0.1\n"
    dns = warc_record("response", "dns:x.example", block, "text/dns")
    (record, _) = read(members(dns))
    assert record[4] is None and record[5] == block
    assert payloads(members(dns, response(page(1))), html_only=True) == [page(1)]


def test_arc():
    def arc(uri, kind, block):
        return b"%s 1.2.3.4 20080430204825 %s %d\n%s\n" % (uri, kind, len(block), block)

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    parts = [
        arc(b"filedesc://x.arc", b"text/plain", b"1 0 Test\nURL IP-address Archive-date Content-type Archive-length\n"),
        arc(b"http://x/1", b"text/html", http + page(1)),
        arc(b"http://x/2", b"text/html", http + page(2)),
    ]
    for data in (b"".join(parts), members(*parts)):
        rows = read(data)
        assert [r[2] for r in rows[:-1]] == ["warcinfo", "response", "response"]
        assert payloads(data, html_only=True) == [page(1), page(2)]
    rows, marks = in_ranges(members(*parts), 100)
    assert len(rows) == 3


@pytest.mark.parametrize(
    "data",
    [
        members(response(page(1)), response(page(2)))[:-30],
        b"".join([response(page(1)), response(page(2))])[:-30],
        members(response(page(1))) + b"garbage",
        gzip.compress(b"no archive at all"),
        b"no archive at all",
        members(response(page(1)).replace(b"Content-Length", b"Content-Size")),
        members(response(b"\x0b\x02", HTML | {"Content-Encoding": "br"})),
    ],
)
def test_broken_archives(data):
    with pytest.raises(ArchiveError):
        read(data)


def test_payload_limit():
    with pytest.raises(ArchiveError):
        read(members(response(b"x" * 1000)), max_payload=500)
    with pytest.raises(ArchiveError):
        read(members(response(gzip.compress(b"x" * 100_000), {"Content-Encoding": "gzip"})), max_payload=5000)
    assert read(b"") == [("split", 0, None)]


def test_scan(spark, tmp_path):
    put(tmp_path, "a.warc.gz", members(warcinfo(), *(response(page(i)) for i in range(50))))
    put(tmp_path, "b.warc.gz", members(response(page(1)))[:-20])
    put(tmp_path, "empty.warc.gz", b"")
    files = archive_listing(spark, str(tmp_path))
    files = files.unionByName(spark.createDataFrame([("/none/c.gz", "c.gz", 10)], files.schema))
    scan = scan_archives(files, 4, split_bytes=1000).persist()
    found = records(scan)
    assert found.columns[:4] == ["path", "basename", "rec_offset", "rec_type"]
    assert found.groupBy("basename").count().collect() == [("a.warc.gz", 50)]
    assert found.select("rec_offset").distinct().count() == 50
    errors = dict(scan.where("kind = 'error'").select("basename", "error").collect())
    assert errors.keys() == {"b.warc.gz", "c.gz"} and errors["c.gz"] == "missing"
    assert broken_splits(scan).count() == 0
    scan.unpersist()


def test_broken_splits_are_found(spark, tmp_path):
    put(tmp_path, "good.warc.gz", members(*(response(page(i)) for i in range(30))))
    put(tmp_path, "odd.warc.gz", members(response(page(1))) + nested_archive() + members(response(page(2))))
    scan = scan_archives(archive_listing(spark, str(tmp_path)), 4, split_bytes=1500)
    assert [r[0].rsplit("/", 1)[1] for r in broken_splits(scan).collect()] == ["odd.warc.gz"]
    whole = scan_archives(archive_listing(spark, str(tmp_path)), 4, split_bytes=None)
    assert records(whole).groupBy("basename").count().orderBy("basename").collect() == [
        ("good.warc.gz", 30),
        ("odd.warc.gz", 2),
    ]


def test_format(spark, tmp_path, plan_of):
    put(tmp_path, "a.warc.gz", members(warcinfo(), response(page(1)), response(page(2), {})))
    put(tmp_path, "_ignored", b"x")
    register(spark)
    rows = spark.read.format("warc").load(str(tmp_path))
    assert rows.count() == 3
    assert rows.where("payload IS NOT NULL").count() == 3
    assert spark.read.format("warc").option("payload", "false").load(str(tmp_path)).where("payload IS NULL").count() == 3
    assert spark.read.format("warc").option("htmlOnly", "true").load(str(tmp_path)).count() == 1
    pushed = (
        spark.read.format("warc").option("pushdown", "true").load(str(tmp_path))
        .where(F.col("rec_type").isin("response", "resource") & F.col("content_type").contains("html"))
    )
    assert pushed.count() == 1
