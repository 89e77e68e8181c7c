import io

import pytest
import zstandard

from pagemill.llm import store, warc_zstd as wz

PAGES = "page_id long, url string, html string, payload string, refers_to string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], PAGES)


ROWS = [
    (5, "http://a/", "<p>same</p>"), (2, "http://b/", "<p>same</p>"), (9, None, "<p>same</p>"),
    (3, "u\r\nWARC-Type: x", ""), (4, "u", None), (7, "u", "ß" * 200_000), (2, "again", "<p>same</p>"),
    (8, "u", "a\r\n\r\nb\r\n\r\n"), (None, "u", "<p>same</p>"), (None, "u", "alone"),
]


@pytest.mark.parametrize("size", [1, 1 << 20])
def test_round_trip(spark, size):
    place = store.folder(spark, "test-warc")
    archives = wz.write_pages(pages(spark, ROWS), place, archive_bytes=size)
    records = wz.read_archives(archives)
    assert records.where("error IS NOT NULL").count() == 0
    got = sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
         for r in wz.pages_of(records).collect()), key=str,
    )
    wanted = []
    for key, _, html in ROWS:
        data = (html or "").encode()
        first = min((k for k, _, h in ROWS if (h or "") == (html or "") and k is not None), default=None)
        revisit = first is not None and first != key
        kind = "revisit" if revisit else "response"
        wanted.append((key, len(data), wz.base32_sha1(data), kind, first if revisit else None))
    assert got == sorted(wanted, key=str)


def test_small_payloads_are_never_revisits(spark):
    place = store.folder(spark, "test-warc")
    archives = wz.write_pages(pages(spark, ROWS), place, smallest_revisit=12)
    kinds = {r.record_type for r in wz.read_archives(archives).collect()}
    assert kinds == {"response"}


def test_no_pages(spark):
    archives = wz.write_pages(pages(spark, []), store.folder(spark, "test-warc"))
    assert wz.pages_of(wz.read_archives(archives)).count() == 0


def records(n=300):
    return [
        wz.record(f"urn:x:{i}", "response", f"http://h/{i}", b"<html>some page %d</html>" % i, None)
        for i in range(n)
    ]


def read(data):
    return list(wz.read_archive(io.BytesIO(data)))


def test_dictionary_is_in_front_and_needed():
    data = wz.archive(records())
    assert data[:4] == wz.DICTIONARY_FRAME.to_bytes(4, "little")
    assert [r.error for r in read(data)] == [None] * 300
    size = int.from_bytes(data[4:8], "little")
    assert read(data[8 + size :])[0].error
    plain = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    uncompressed = data[:4] + len(plain).to_bytes(4, "little") + plain + data[8 + size :]
    assert [r.error for r in read(uncompressed)] == [None] * 300


def frames(*contents):
    return b"".join(zstandard.ZstdCompressor().compress(c) for c in contents)


def test_faults_are_records_with_errors():
    good = records(3)
    bad = [
        good[0].replace(b"WARC/1.1", b"HTTP/1.1"),
        good[0].replace(b"Content-Length: ", b"Content-Length: 9", 2),
        good[0].replace(b"WARC-Date", b"Date"),
        good[0] + good[1],
        good[0][:-1],
        b"WARC/1.1\r\nno end",
        good[0].replace(b"WARC-Type: ", b"WARC-Type "),
    ]
    found = read(frames(good[0], *bad, good[2]))
    assert [r.error is None for r in found] == [True, *[False] * len(bad), True]


@pytest.mark.parametrize("cut", [3, 6, 40, -5])
def test_cut_off_archives(cut):
    data = wz.archive(records())
    assert read(data[:cut])[-1].error


def test_damage_in_the_middle():
    data = frames(*records(3))
    first = len(frames(records(1)[0]))
    found = read(data[:first] + b"\0\0\0\0" + data[first:])
    assert [r.error is None for r in found] == [True, False, True, True]
    assert read(b"") == []
    assert len(read((0x184D2A50).to_bytes(4, "little") + b"\2\0\0\0ab" + frames(records(1)[0]))) == 1


def test_one_changed_byte_anywhere_costs_one_record():
    data = wz.archive(records(40))
    size = 8 + int.from_bytes(data[4:8], "little") if data[:4] == wz.DICTIONARY_FRAME.to_bytes(4, "little") else 0
    whole = [r.header("WARC-Record-ID") for r in read(data)]
    step = max(1, (len(data) - size) // 300)
    for at in range(size, len(data), step):
        found = read(data[:at] + bytes([data[at] ^ 0xA5]) + data[at + 1 :])
        good = [r.header("WARC-Record-ID") for r in found if r.error is None]
        assert 1 <= sum(r.error is not None for r in found) <= 2
        assert len(good) >= 38 and [x for x in whole if x in set(good)] == good


def test_lost_stretches_and_false_frame_beginnings():
    data = frames(*records(6))
    at = [len(frames(*records(i))) for i in range(7)]
    magic = wz.FRAME_MAGIC.to_bytes(4, "little")
    found = read(data[: at[2]] + magic * 50 + b"\xff" * (3 << 20) + magic + data[at[2] :])
    assert [r.error is None for r in found] == [True, True, False, True, True, True, True]
    found = read(data[: at[1] + 9] + data[at[2] :])  # the end of a frame is gone
    assert sum(r.error is None for r in found) == 5 and sum(r.error is not None for r in found) == 1


def test_damage_between_writing_and_reading_is_not_silent(spark):
    place = store.folder(spark, "test-warc")
    rows = [(i, "u", f"<p>page {i} of many</p>" * 20) for i in range(200)]
    archives = wz.write_pages(pages(spark, rows), place, archive_bytes=20_000)
    records = wz.read_archives(archives)
    assert wz.pages_of(records, archives).count() == 200
    path, n = archives.first()
    with open(path, "rb") as file:
        data = file.read()
    frame = data.index(wz.FRAME_MAGIC.to_bytes(4, "little"), len(data) // 2)
    with open(path, "wb") as file:
        file.write(data[: frame + 8] + bytes([data[frame + 8] ^ 0xFF]) + data[frame + 9 :])
    assert records.where("error IS NULL").count() == 199
    assert records.where("error IS NOT NULL").count() == 1
    with pytest.raises(ValueError, match="frame cannot be read"):
        wz.pages_of(records, archives)
    with open(path, "wb") as file:
        file.write(data[:frame])  # a whole number of records, but not all
    with pytest.raises(ValueError, match=f"of {n} records"):
        wz.pages_of(records, archives)


def test_another_digest(spark):
    record = records(1)[0].replace(b"some page", b"evil page")
    path = store.write_file(store.folder(spark, "test-warc"), frames(record))
    row = wz.read_archives(spark.createDataFrame([(path,)], "path string")).first()
    assert row.error == "the payload has another digest"
