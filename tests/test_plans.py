"""What the physical plans must look like."""

import pytest
from pyspark.sql import functions as F

from pagemill.operators import corpus, ledger, manifest
from pagemill.plans import queries as q
from pagemill.session import scratch_dir, spread
from pagemill.sources.warc import RECORD_DDL, _FilteringWarcReader, register
from tests.archives import members, put, response

SF = "/root/testdata/sf0.001"


def test_cheap_filters_run_before_extraction(spark, plan_of):
    plan = plan_of(q.clean_records(spark, SF), "simple")
    assert plan.count("ArrowEvalPython") == 1
    above, below = plan.split("ArrowEvalPython", 1)
    assert "length(" in above and "page_id" in below and "html" in below
    assert below.index("Exchange") < below.index("Filter") < below.index("FileScan")


def test_scans_read_only_what_is_needed(spark, plan_of):
    assert "ReadSchema: struct<page_id:bigint>" in plan_of(q.html_filter(spark, SF))
    assert "ReadSchema: struct<url:string>" in plan_of(q.dedupe_basename(spark, SF))
    plan = plan_of(q.ledger_insert_absent(spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)" in plan
    assert "content" not in plan_of(corpus.list_outputs(spark, SF, "*.parquet"), "simple").split("FileScan")[1].split("ReadSchema")[1]


@pytest.mark.parametrize("name", ["file_metrics", "ledger_add_deltas", "ledger_set_latest", "ledger_remove",
                                  "active_workers", "dedupe_basename", "run_totals", "download_revert"])
def test_aggregates_are_partly_done_before_the_shuffle(spark, plan_of, name):
    plan = plan_of(getattr(q, name)(spark, SF), "simple")
    assert "partial_" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_skip_is_an_anti_join_broadcast_by_size_only(spark, plan_of):
    plan = plan_of(q.skip_cleaned(spark, SF), "simple")
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(q.skip_cleaned(spark, SF), "simple")
        assert "SortMergeJoin" in plan and "LeftAnti" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_of_a_join_is_split(spark, plan_of):
    """A third of the rows with one key, no broadcast: AQE divides that key's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 300_000, 1, 8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS basename", "id"
        )
        done = spark.range(0, 300_000, 2, 8).selectExpr("concat('k', id) AS basename")
        left = manifest.skip_cleaned(rows, done)
        n = left.collect()
        assert len(n) == 100_000 + 100_000
        assert "skew=true" in plan_of(left, "simple")
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_revert_fold_shuffles_the_rows_once(spark, plan_of):
    plan = plan_of(q.download_revert(spark, SF), "simple")
    # raw rows go by (key, run); everything after that is pre-aggregated
    first = plan[: plan.rindex("FileScan")]
    assert "Window" in first
    assert "hashpartitioning(user_id" in first and "_run" in first


def test_corpus_is_sorted_once(spark, tmp_path):
    rows = spark.range(1000).selectExpr(
        "concat('f', id % 5) AS basename", "id AS rec_offset", "concat('t', id) AS text"
    )
    corpus.write_corpus(rows, str(tmp_path / "c"), span=100)
    store = spark._jsparkSession.sharedState().statusStore()
    executions = store.executionsList()
    last = executions.apply(executions.size() - 1)
    text = last.physicalPlanDescription()
    assert "Insert" in text
    body = text.split("== Final Plan ==")[-1].split("== Initial Plan ==")[0].split("\n\n")[0]
    assert body.count("Sort (") == 1 and body.count("Exchange (") == 1


def test_spread_only_when_there_are_too_few_partitions(spark):
    cores = spark.sparkContext.defaultParallelism
    few, many = spark.range(10).repartition(1).rdd.getNumPartitions(), spark.range(0, 100, 1, cores)
    assert few == 1
    assert spread(many) is many
    scan = spark.read.parquet(f"{SF}/pages.parquet")
    assert spread(scan).rdd.getNumPartitions() == cores


def test_archive_source_sees_filters(spark, tmp_path):
    put(tmp_path, "a.warc.gz", members(response(b"x"), response(b"y", {"Content-Type": "text/plain"})))
    register(spark)
    rows = spark.read.format("warc").option("pushdown", "true").load(str(tmp_path))
    assert rows.where(F.col("content_type").contains("html")).count() == 1
    reader = _FilteringWarcReader({"path": str(tmp_path), "pushdown": "true"})
    from pyspark.sql.datasource import In, IsNotNull, StringContains

    filters = [
        In(("rec_type",), ("response", "resource")),
        IsNotNull(("http_headers",)),
        StringContains(("content_type",), "html"),
    ]
    assert list(reader.pushFilters(filters)) == filters and len(reader.checks) == 3
    got = [b.num_rows for p in reader.partitions() for b in reader.read(p)]
    assert sum(got) == 1
    assert [f.split()[0] for f in RECORD_DDL.split(", ")][:3] == ["path", "basename", "rec_offset"]


def test_scratch_follows_the_cluster_setting(spark, tmp_path, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = scratch_dir(spark, "x")
    assert folder.rsplit("/", 1)[1].startswith("x-")
    if shared:
        assert folder.startswith(shared.rstrip("/"))
    assert scratch_dir(spark, "x") != folder


def test_keys_with_many_events_are_folded_in_runs(spark):
    """All events of one key: more than one task works on them."""
    events = spark.range(0, 20_000, 1, 4).selectExpr(
        "id AS seq", "'hot' AS k", "id AS bytes", "CASE WHEN id % 7 = 3 THEN 'r' ELSE 'd' END AS kind"
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ledger.downloads_in_effect(
            events, "k", "seq", "bytes", F.col("kind") == "d", F.col("kind") == "r", 1000
        )
        last = max(i for i in range(20_000) if i % 7 == 3)
        assert [tuple(r) for r in got.collect()] == [("hot", last + 1)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
