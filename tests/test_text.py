import random
import re
from datetime import datetime, timedelta

from pagemill.functions import text as fn

SPACES = [chr(i) for i in range(0x10000) if chr(i).isspace()]


def test_the_29_white_space_characters():
    assert len(SPACES) == 29 and sorted(fn.SPACES) == SPACES


def test_white_space_like_python(spark):
    pick = random.Random(7)
    alphabet = SPACES + list("ab​᠎﻿😀")
    rows = [(i, "".join(pick.choices(alphabet, k=pick.randrange(14)))) for i in range(3000)]
    rows += [(10_000 + i, f"a{chr(i)}b{chr(i)}") for i in range(1, 0x3100)]
    got = spark.createDataFrame(rows, "i INT, s STRING").select(
        "i",
        fn.collapse_whitespace("s"),
        fn.strip("s"),
        fn.char_length("s"),
        fn.byte_length("s"),
    )
    texts = dict(rows)
    for i, collapsed, stripped, chars, size in got.collect():
        s = texts[i]
        assert collapsed == re.sub(r"\s+", " ", s).strip()
        assert stripped == s.strip()
        assert (chars, size) == (len(s), len(s.encode()))


def test_decode_payload(spark):
    rows = [(b"abc",), ("é😀".encode(),), ("é".encode("latin-1"),), (bytes(range(256)),), (b"",), (b"\xef\xbb\xbfx",), (b"\xed\xa0\x80",)]

    def expected(b):
        try:
            return b.decode("utf-8")
        except UnicodeDecodeError:
            return b.decode("latin-1")

    got = spark.createDataFrame(rows, "b BINARY").select("b", fn.decode_payload("b").alias("t"))
    for b, t in got.collect():
        assert t == expected(bytes(b))


def test_names(spark):
    rows = [("a/b/c.gz",), ("c.gz",), ("a/c.gz/",), ("a//c.gz//",), ("",)]
    got = spark.createDataFrame(rows, "p STRING").select(fn.basename("p")).collect()
    assert [r[0] for r in got] == ["c.gz", "c.gz", "c.gz", "c.gz", ""]
    names = spark.createDataFrame([("a.txt",), ("a.txt.txt",), ("a.txtx",)], "n STRING")
    assert [r[0] for r in names.select(fn.drop_output_suffix("n")).collect()] == ["a", "a.txt", "a.txtx"]
    assert names.select(fn.output_name("/out/", "n")).first()[0] == "/out/a.txt.txt"


def test_sizes(spark):
    rows = [("0",), ("",), (None,), ("12a",), ("٣",), ("1048576",), (" 5",), ("9" * 30,), ("5\n",)]
    got = spark.createDataFrame(rows, "s STRING").select(fn.estimated_size("s")).collect()
    unknown = 50 * 1024 * 1024
    assert [r[0] for r in got] == [0, unknown, unknown, unknown, unknown, 1048576, unknown, 2**63 - 1, unknown]
    sizes = [0, 1, 9, 10, 11, 99, 1_000_000_007, 52_428_800]
    got = spark.createDataFrame([(s,) for s in sizes], "s BIGINT").select(fn.needed_space("s")).collect()
    assert [r[0] for r in got] == [int(s * 1.10) for s in sizes]


def test_display_like_python(spark):
    pick = random.Random(3)
    sizes = [0, 5368709, 16106127, 26843545, -5368709120, 1024**3] + [pick.randrange(-(10**9), 10**14) for _ in range(500)]
    got = spark.createDataFrame([(s,) for s in sizes], "s BIGINT").select("s", fn.as_gigabytes("s"), fn.as_megabytes("s"))
    for s, gb, mb in got.collect():
        assert gb.replace("-0.00", "0.00") == f"{s / 1024**3:.2f} GB".replace("-0.00", "0.00")
        assert mb == f"{s / 1024**2:.1f} MB"
    seconds = [0, 59, 60, 3599, 3600, 86399, 86400, 86401, 172800, 10**7, 10**9]
    got = spark.createDataFrame([(s + 0.9,) for s in seconds], "s DOUBLE").select(fn.as_elapsed("s")).collect()
    assert [r[0] for r in got] == [str(timedelta(seconds=s)) for s in seconds]


def test_iso_times(spark):
    times = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 60), datetime(1999, 12, 31, 23, 59, 59, 999999)]
    frame = spark.createDataFrame([(t,) for t in times], "t TIMESTAMP").select(fn.to_iso("t").alias("s"))
    assert [r[0] for r in frame.collect()] == [t.isoformat() for t in times]
    assert [r[0] for r in frame.select(fn.from_iso("s")).collect()] == times


def test_lists_like_python(spark):
    pick = random.Random(5)
    rows = [(pick.choices("abc", k=pick.randrange(6)), pick.choice("abcd")) for _ in range(300)] + [(None, "a")]
    got = spark.createDataFrame(rows, "l ARRAY<STRING>, x STRING").select(
        "l", "x", fn.list_add("l", "x"), fn.list_remove("l", "x")
    )
    for items, x, added, removed in got.collect():
        have = items or []
        assert added == (have if x in have else have + [x])
        if items is not None:
            rest = list(items)
            if x in rest:
                rest.remove(x)
            assert removed == rest


def test_counter_and_label(spark):
    frame = spark.createDataFrame([(None, 1), (2, 3)], "c BIGINT, n INT")
    assert [r[0] for r in frame.select(fn.add_to_counter("c", "n")).collect()] == [1, 5]
    assert [r[0] for r in frame.select(fn.node_label("n", 2)).collect()] == ["N0", "N1"]
