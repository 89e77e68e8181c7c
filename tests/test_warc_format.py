import pytest

from pagemill.sources.warc import RECORD_DDL, archive_listing, plan_ranges, register
from tests.archives import members, nested_archive, page, put, response, warcinfo


def read(spark, path, **options):
    register(spark)
    rows = spark.read.format("warc").options(**options).load(str(path)).collect()
    place = lambda r: (r.basename, r.rec_offset or -1, r.rec_number or 0, r.error or "")
    return sorted((tuple(r) for r in rows), key=lambda r: (r[1], r[2] or -1, r[8] or 0, r[7] or "")), place


@pytest.mark.parametrize("split", [700, 3000, 1 << 20])
def test_ranges_give_the_rows_of_the_whole(spark, tmp_path, split):
    put(tmp_path, "a.warc.gz", members(warcinfo(), *(response(page(i, 30 + i)) for i in range(60))))
    put(tmp_path, "plain.warc", b"".join(response(page(i)) for i in range(20)))
    put(tmp_path, "one.warc.gz", members(b"".join(response(page(i)) for i in range(40))))
    put(tmp_path, "small.warc.gz", members(response(page(1))))
    whole, _ = read(spark, tmp_path, splitBytes=0)
    assert len(whole) == 122 and not any(r[7] for r in whole)
    ranges, _ = read(spark, tmp_path, splitBytes=split)
    assert ranges == whole


def test_tasks(spark, tmp_path):
    put(tmp_path, "a.warc.gz", members(*(response(page(i)) for i in range(200))))
    register(spark)
    frame = spark.read.format("warc").option("splitBytes", 2000).load(str(tmp_path))
    assert frame.rdd.getNumPartitions() > 10
    sizes = [("a", 10), ("b", 20), ("c", 250), ("d", 90), ("e", 0)]
    parts = [[(p.path, p.start, p.stop) for p in t.parts] for t in plan_ranges(sizes, 100)]
    assert parts == [
        [("c", 0, 100)], [("c", 100, 200)], [("c", 200, 300)],
        [("a", 0, None), ("b", 0, None)], [("d", 0, None), ("e", 0, None)],
    ]
    assert len(plan_ranges(sizes, 0)) == 5


def test_a_payload_that_looks_like_an_archive_is_never_silently_wrong(spark, tmp_path):
    first, last = members(*(response(page(i)) for i in range(3))), members(*(response(page(9 + i)) for i in range(3)))
    put(tmp_path, "odd.warc.gz", first + nested_archive() + last)
    whole, _ = read(spark, tmp_path, splitBytes=0)
    assert len(whole) == 7
    seen = {"right": 0, "wrong": 0}
    for split in range(500, 6000, 550):
        rows, _ = read(spark, tmp_path, splitBytes=split)
        wrong = any(r[7] for r in rows)
        assert wrong or rows == whole
        seen["wrong" if wrong else "right"] += 1
    assert seen["wrong"]


def test_damaged_archives_give_error_rows(spark, tmp_path):
    data = members(*(response(page(i)) for i in range(30)))
    put(tmp_path, "cut.warc.gz", data[:-30])
    for split in (0, 1500):
        rows, _ = read(spark, tmp_path, splitBytes=split)
        assert [r for r in rows if r[7]] and len([r for r in rows if not r[7]]) >= 28


def test_listing_instead_of_a_path(spark, tmp_path):
    put(tmp_path / "x", "a.warc.gz", members(*(response(page(i)) for i in range(5))))
    put(tmp_path / "y", "b.warc.gz", members(*(response(page(i)) for i in range(6))))
    listing = archive_listing(spark, str(tmp_path / "*"))
    listing.select("path", "length").write.parquet(str(tmp_path / "listing"))
    register(spark)
    rows = spark.read.format("warc").option("listing", str(tmp_path / "listing")).load()
    assert rows.groupBy("basename").count().orderBy("basename").collect() == [("a.warc.gz", 5), ("b.warc.gz", 6)]
    assert rows.schema == spark.createDataFrame([], RECORD_DDL).schema
