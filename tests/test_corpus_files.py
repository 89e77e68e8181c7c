from pathlib import Path

import pytest
from pyspark.sql import functions as F

from pagemill.constants import RECORD_SEPARATOR
from pagemill.sources import corpus_files
from pagemill.sources.corpus_files import read_corpus_files, write_corpus_files

ROWS = "basename STRING, rec_offset BIGINT, rec_number BIGINT, text STRING"


def rows(spark, n=300):
    data = [
        (f"a {i % 3}+é.gz", (i * 7919) % 1000 // 2, (i * 7919) % 1000, f"text {i} ß" * (i % 5)) for i in range(n)
    ]
    return data, spark.createDataFrame(data, ROWS).repartition(5)


def visible(folder) -> set[str]:
    return {p.name for p in Path(folder).iterdir() if not p.name.startswith((".", "_"))}


def test_bytes_are_those_of_the_records_in_order(spark, tmp_path):
    data, frame = rows(spark)
    write_corpus_files(frame, str(tmp_path / "out"))
    assert visible(tmp_path / "out") == {f"a {i}+é.gz.txt" for i in range(3)}
    for name in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == name), key=lambda r: (r[1], r[2]))
        assert (tmp_path / "out" / f"{name}.txt").read_text() == "".join(r[3] + RECORD_SEPARATOR for r in mine)
    assert not list((tmp_path / "out").glob(".*.part"))
    back = read_corpus_files(spark, str(tmp_path / "out")).groupBy("basename", "value").count().collect()
    wanted = frame.groupBy("basename", F.col("text").alias("value")).count().collect()
    assert sorted(map(tuple, back)) == sorted(map(tuple, wanted))


def test_another_write_replaces_its_own_archives(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1, 0, "old"), ("b", 1, 0, "old")], ROWS)
    write_corpus_files(frame, str(tmp_path))
    write_corpus_files(spark.createDataFrame([("a", 1, 0, "new")], ROWS), str(tmp_path))
    assert (tmp_path / "a.txt").read_text() == "new" + RECORD_SEPARATOR
    assert (tmp_path / "b.txt").read_text() == "old" + RECORD_SEPARATOR


def test_nothing_appears_when_the_job_fails(spark, tmp_path):
    data, frame = rows(spark)
    write_corpus_files(spark.createDataFrame([("a 1+é.gz", 1, 0, "before")], ROWS), str(tmp_path))
    last = max(r[2] for r in data if r[0] == "a 1+é.gz")
    sorted_rows = frame.repartition(3, "basename").sortWithinPartitions("basename", "rec_offset", "rec_number")
    # fails in the task that writes, after it has written most of an archive
    value = F.when(F.col("rec_number") == last, F.raise_error(F.lit("stop"))).otherwise(F.col("text"))
    with pytest.raises(Exception, match="stop"):
        sorted_rows.select("basename", value.alias("value")).write.format("corpus").mode("append").save(str(tmp_path))
    assert visible(tmp_path) == {"a 1+é.gz.txt"}
    assert (tmp_path / "a 1+é.gz.txt").read_text() == "before" + RECORD_SEPARATOR
    assert not list(tmp_path.glob(".a 1*.part"))


def test_commit_and_abort(tmp_path):
    writer = corpus_files._CorpusWriter(str(tmp_path))
    for name in ("x", "y"):
        (tmp_path / f".{name}.part").write_text(name)
    message = corpus_files._Written([(str(tmp_path / f".{n}.part"), str(tmp_path / f"{n}.txt")) for n in ("x", "y")])
    corpus_files._CorpusWriter(str(tmp_path)).abort([None, corpus_files._Written([(str(tmp_path / ".gone"), "z")])])
    writer.commit([message, None])
    assert visible(tmp_path) == {"x.txt", "y.txt"}
    (tmp_path / ".x.part").write_text("again")
    writer.abort([corpus_files._Written([(str(tmp_path / ".x.part"), "x")])])
    assert not (tmp_path / ".x.part").exists()


def test_no_rows_and_other_columns(spark, tmp_path):
    write_corpus_files(spark.createDataFrame([], ROWS), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists() or visible(tmp_path / "none") == set()
    spark.dataSource.register(corpus_files.CorpusDataSource)
    with pytest.raises(Exception, match="columns"):
        spark.range(3).write.format("corpus").mode("append").save(str(tmp_path))
