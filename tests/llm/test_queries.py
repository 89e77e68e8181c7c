import pytest

import __spark_entry__ as entry
import corpus_pipeline
from pagemill.llm import queries as llm
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {n[: n.index("_") + 1] for n in llm.QUERIES}
    assert set(llm.QUERIES) | {"pipeline"} <= names.keys()
    assert llm.ORACLE_SQL.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(llm.ORACLE_SQL))
def test_query_against_sql(spark, name):
    _, problem = compare(spark, connect(SF), SF, llm.QUERIES[name], llm.ORACLE_SQL[name])
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(llm.QUERIES.keys() - llm.ORACLE_SQL.keys()))
def test_query_covers_its_table(spark, name):
    frame = llm.QUERIES[name](spark, SF)
    table = "embeddings" if "neighbours" in name else "documents"
    rows = spark.read.parquet(f"{SF}/{table}.parquet")
    if table == "documents":
        assert frame.select("doc_id").distinct().count() == rows.count()
    else:
        assert frame.count() == 20 * rows.where("vec_id % 20 = 0").count()


def test_pipeline(spark, documents):
    """Each stage on small documents of which it must keep, drop or change given ones."""
    base = "the quick brown fox jumps over the lazy dog near the river bank " * 3
    rows = [(i, f"{base} own{i} words{i} here{i} for{i} this{i} " * 2, "en", "ab"[i % 2]) for i in range(30)]
    rows += [(100, rows[0][1], "en", "a"), (101, None, "en", "a"), (102, "123", "en", "a"),
             (103, "mail bo@mail.example.com please " + " ".join(f"z{i}" for i in range(40)), "en", "b")]
    docs = documents(rows, extra=False)
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language ID", "MinHash near-dedup", "PII", "mixing", "packing",
    ]
    one = stages["language ID"](spark, docs, SF)
    assert {r.doc_id for r in one.collect()} == {r[0] for r in rows} - {101, 102}
    two = stages["MinHash near-dedup"](spark, one, SF)
    assert 100 not in {r.doc_id for r in two.collect()} and 0 in {r.doc_id for r in two.collect()}
    three = stages["PII"](spark, two, SF)
    assert not [r for r in three.collect() if "bo@mail" in r.text]
    four = stages["mixing"](spark, three, SF)
    assert one.columns == two.columns == three.columns == four.columns == docs.columns
    five = stages["packing"](spark, four, SF)
    assert five.where("start = 0").count() == four.count()


def test_pipeline_runs_whole(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert packed.count() > 0
    none = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name
