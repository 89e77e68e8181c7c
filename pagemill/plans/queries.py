"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.constants import RECORD_SEPARATOR
from pagemill.functions import text as fn
from pagemill.operators import activity, corpus, ledger, manifest, retries, sketch
from pagemill.operators.records import clean_pages, extract_pages, html_records
from pagemill.plans.batch import (
    COUNTERS,
    FETCH_LOG_DDL,
    Layout,
    batch_counters,
    clean_corpus,
    ledger_rows,
    corpus_outputs,
    read_table,
    rebuild_ledger,
    recover_ledger,
    run_batch,
    run_fetch,
)
from pagemill.plans.retry import retry_table
from pagemill.plans.run import run_to_end
from pagemill.session import scratch_dir, spread
from pagemill.sources import state_json
from pagemill.sources.archive_fixture import copy_archives, write_archives
from pagemill.sources.corpus_files import read_corpus_files, write_corpus_files
from pagemill.sources.warc import (
    archive_listing,
    broken_splits,
    records,
    register,
    scan_archives,
)
from pagemill.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]

ROWS_PER_ARCHIVE = 5000  # rows of one bucket that go into one archive file
QUERY_SPLIT = 64 * 1024  # bytes; so that the archives of small tables are split too
CORPUS_SPAN = 100_000  # positions (pages) that share an output file
EPOCH = "TIMESTAMP '2024-01-01 00:00:00'"
RETRY_NOW = "2024-01-30 12:00:00"


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def heavy(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Pages, spread over the cores: extraction is worth more than a scan of one file."""
    return spread(table(spark, sf, "pages", *columns))


def with_record_columns(pages: DataFrame) -> DataFrame:
    """The derived view of FIXTURES.md: pages as archive records."""
    return pages.selectExpr(
        "concat('part-', page_id % 8, '.warc.gz') AS basename",
        "page_id AS rec_offset",
        "CASE page_id % 5 WHEN 0 THEN 'request' WHEN 1 THEN 'resource' ELSE 'response' END AS rec_type",
        "CASE page_id % 7 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'text/HTML' WHEN 2 THEN NULL "
        "ELSE 'text/html; charset=utf-8' END AS content_type",
        *(c for c in ("url",) if c in pages.columns),
        *(["html AS payload"] if "html" in pages.columns else []),
    )


def clean_records(spark: SparkSession, sf: str) -> DataFrame:
    # the cheap filter goes first and only what passes it is shuffled
    rows = with_record_columns(table(spark, sf, "pages", "page_id", "html"))
    return clean_pages(spread(html_records(rows)))


# ---- scalars -------------------------------------------------------------


def scalar_collapse_ws(spark, sf):
    return spread(table(spark, sf, "documents", "doc_id", "text")).select(
        "doc_id",
        fn.collapse_whitespace("text").alias("collapsed"),
        fn.char_length(fn.strip("text")).alias("stripped_chars"),
        fn.char_length("text").alias("n_code_points"),
        fn.byte_length("text").alias("n_bytes"),
    )


def manifest_resolve(spark, sf):
    lines = table(spark, sf, "pages", "page_id", "url").selectExpr(
        "page_id",
        r"CASE page_id % 6 WHEN 0 THEN concat('  ', url, '\t') WHEN 1 THEN concat('#', url) "
        r"WHEN 2 THEN ' \t ' WHEN 3 THEN concat('  #', url) "
        r"WHEN 4 THEN concat(char(160), url, '/') ELSE url END AS value",
    )
    return manifest.resolve_lines(lines)


def decode_payload(spark, sf):
    pages = table(spark, sf, "pages", "page_id", "html")
    latin = F.regexp_replace("html", r"[^\x00-\xff]", "?")
    raw = F.when(F.col("page_id") % 3 == 0, F.encode(latin, "ISO-8859-1")).otherwise(
        F.encode("html", "UTF-8")
    )
    return pages.select("page_id", fn.decode_payload(raw).alias("text"))


def size_rules(spark, sf):
    lengths = table(spark, sf, "pages", "page_id").selectExpr(
        "page_id",
        "CASE page_id % 6 WHEN 0 THEN '0' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '12a' "
        "ELSE CAST(page_id * 1048576 AS STRING) END AS content_length",
    )
    size = fn.estimated_size("content_length")
    return lengths.where(size != 0).select(
        "page_id",
        size.alias("size"),
        fn.needed_space(size).alias("needed"),
        F.coalesce(
            manifest.size_status("content_length", 200 * 1024 * 1024), F.lit("to_fetch")
        ).alias("status"),
    )


def display_formats(spark, sf):
    orders = table(spark, sf, "orders", "o_orderkey", "o_totalprice")
    amount = F.round(F.col("o_totalprice") * 1e6).cast("bigint")
    return orders.select(
        "o_orderkey",
        fn.as_gigabytes(amount).alias("gigabytes"),
        fn.as_megabytes(amount).alias("megabytes"),
        fn.as_elapsed(F.col("o_totalprice")).alias("elapsed"),
    )


def iso_times(spark, sf):
    events = table(spark, sf, "events", "event_id", "ts")
    text = fn.to_iso(F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts")))
    return events.select("event_id", text.alias("iso")).select(
        "event_id", "iso", F.unix_micros(fn.from_iso("iso")).alias("micros")
    )


def list_edits(spark, sf):
    words = table(spark, sf, "part", "p_partkey", "p_name", "p_brand", "p_type").select(
        "p_partkey",
        F.when(F.col("p_partkey") % 9 != 0, F.split("p_name", " ")).alias("words"),
        "p_brand",
        F.split("p_type", " ")[0].alias("item"),
    )
    doubled = F.concat(F.col("words"), F.col("words"))
    first = F.col("words")[0]
    return words.select(
        "p_partkey",
        F.array_join(fn.list_add("words", "p_brand"), "|").alias("added"),
        F.array_join(fn.list_add("words", F.coalesce(first, F.col("item"))), "|").alias("added_again"),
        F.array_join(fn.list_remove(doubled, first), "|").alias("removed"),
        F.array_join(fn.list_remove("words", "p_brand"), "|").alias("not_there"),
    )


# ---- records and text ------------------------------------------------------


def html_filter(spark, sf):
    rows = with_record_columns(table(spark, sf, "pages", "page_id"))
    return html_records(rows).select("basename", "rec_offset", "rec_type", "content_type")


def extract_all(spark, sf):
    return extract_pages(heavy(spark, sf, "page_id", "html"), "html").select(
        "page_id", "route", "n_segments", fn.char_length("text").alias("n_chars"), "text"
    )


def extract_pages_min_len(spark, sf):
    return clean_pages(heavy(spark, sf, "page_id", "url", "html"), "html").select(
        "page_id", "url", "text"
    )


# The tags that stand in for <article> in extract_routes, by page_id % 13.
ROUTE_TAGS = (
    ("<article>", "</article>"),
    ("<main>", "</main>"),
    ('<div role="main">', "</div>"),
    ('<div class="wide content">', "</div>"),
    ('<section id="content">', "</section>"),
    ("<div class='main-content'>", "</div>"),
    ("<div id=main-content>", "</div>"),
    ('<div class="post-body">', "</div>"),
    ('<section class="entry-content">', "</section>"),
    ('<span class="article-body">', "</span>"),
    ("<section>", "</section>"),
    ("<section>", "</section>"),
    ("<section>", "</section>"),
)


def extract_routes(spark, sf):
    """Every page through another branch: ten selectors, paragraphs, body, no body."""
    kind = F.col("page_id") % len(ROUTE_TAGS)
    start = F.array(*(F.lit(a) for a, _ in ROUTE_TAGS))[kind.cast("int")]
    end = F.array(*(F.lit(b) for _, b in ROUTE_TAGS))[kind.cast("int")]
    html = F.replace(F.replace("html", F.lit("<article>"), start), F.lit("</article>"), end)
    plain = F.regexp_replace(html, r"<(/?)p>", r"<$1div>")
    bare = F.regexp_replace(plain, r"</?body>", "")
    page = F.when(kind < 11, html).when(kind == 11, plain).otherwise(bare)
    pages = heavy(spark, sf, "page_id", "html").select("page_id", page.alias("page"))
    return extract_pages(pages, "page").select("page_id", "route", "text")


def warc_roundtrip(spark, sf):
    folder = _archives(spark, sf)
    files = archive_listing(spark, folder)
    scan = scan_archives(files, html_only=True, split_bytes=QUERY_SPLIT)
    found = records(scan)
    return clean_pages(found).select(
        F.col("http_headers")["x-position"].cast("bigint").alias("page_id"),
        "basename",
        "rec_type",
        "content_type",
        "text",
    )


def warc_splits(spark, sf):
    """What the ranges of split archives add up to, and whether they join up."""
    folder = _archives(spark, sf)
    files = archive_listing(spark, folder)
    scan = scan_archives(
        files, html_only=False, with_payload=False, split_bytes=QUERY_SPLIT
    )
    broken = broken_splits(scan).select("path", F.lit(1).alias("broken"))
    return (
        scan.where("kind <> 'split'")
        .groupBy("path", "basename")
        .agg(
            F.count_if(F.col("kind") == "record").alias("n_records"),
            F.count_if(F.col("kind") == "error").alias("n_errors"),
            F.count_if(F.col("http_headers").isNotNull()).alias("n_with_headers"),
        )
        .join(broken, "path", "left")
        .select(
            "basename",
            "n_records",
            "n_errors",
            "n_with_headers",
            F.coalesce("broken", F.lit(0)).alias("n_broken"),
        )
    )


def warc_format(spark, sf):
    """The same archives through spark.read.format("warc"), in ranges, filters pushed where allowed."""
    folder = _archives(spark, sf)
    register(spark)
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    listing = scratch_dir(spark, "listing")
    archive_listing(spark, folder).select("path", "length").write.parquet(listing)
    reader = spark.read.format("warc").option("pushdown", pushdown).option("splitBytes", QUERY_SPLIT)
    rows = reader.option("listing", listing).load()
    kept = rows.where(
        F.col("rec_type").isin("response", "resource")
        & F.col("http_headers").isNotNull()
        & F.col("content_type").contains("html")
    )
    return clean_pages(kept).select(
        F.col("http_headers")["x-position"].cast("bigint").alias("page_id"), "basename", "text"
    )


def _archive_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as records; a bucket is cut into archives of a fixed number of rows."""
    rows = with_record_columns(table(spark, sf, "pages", "page_id", "url", "html"))
    part = F.floor(F.col("rec_offset") / (8 * ROWS_PER_ARCHIVE)).cast("string")
    bucket = (F.col("rec_offset") % 8).cast("string")
    name = F.concat(F.lit("part-"), bucket, F.lit("-"), part, F.lit(".warc.gz"))
    return rows.withColumn("basename", name)


def _archives(spark: SparkSession, sf: str, folder: str | None = None) -> str:
    folder = folder or scratch_dir(spark, "archives")
    write_archives(_archive_rows(spark, sf), folder)
    return folder


def arc_read(spark, sf):
    """Pages written in the older archive format, where every record is a response."""
    folder = scratch_dir(spark, "archives")
    write_archives(_archive_rows(spark, sf), folder, arc=True)
    scan = scan_archives(archive_listing(spark, folder), html_only=True, split_bytes=QUERY_SPLIT)
    return clean_pages(records(scan)).select(
        F.col("http_headers")["x-position"].cast("bigint").alias("page_id"), "basename", "rec_type", "text"
    )


def missing_archives(spark, sf):
    """A third of the listed archives is not there: they are failures, the others are done."""
    layout = Layout(scratch_dir(spark, "run"))
    files = archive_listing(spark, _archives(spark, sf))
    gone = F.regexp_extract("basename", "part-([0-9])", 1).cast("int") % 3 == 1
    elsewhere = F.regexp_replace("path", "/([^/]+)$", "/gone/$1")
    run_batch(
        spark, files.withColumn("path", F.when(gone, elsewhere).otherwise(F.col("path"))), layout,
        split_bytes=QUERY_SPLIT,
    )
    done = ledger_rows(spark, layout).select("basename", F.lit(None).cast("string").alias("reason"))
    return done.unionByName(retry_table(spark, layout).select("basename", "reason"))


def own_extractor(spark, sf):
    """Pages cleaned by another extractor, any column function with the result type of the default."""

    def tags_marked(payload):
        text = F.regexp_replace(payload, "<[^>]*>", "|")
        return F.struct(text.alias("text"), F.lit("own").alias("route"), F.lit(1).alias("n_segments"))

    rows = with_record_columns(table(spark, sf, "pages", "page_id", "html"))
    kept = clean_pages(html_records(rows), extractor=tags_marked)
    return kept.select("basename", "rec_offset", "text", "route")


# ---- corpus and metrics ----------------------------------------------------


def pack_per_file(spark, sf):
    return corpus.pack_text(clean_records(spark, sf), "basename", "rec_offset", "text", span=512)


def pack_conversations(spark, sf):
    turns = table(spark, sf, "conversations", "conv_id", "turn", "text")
    return corpus.pack_text(turns, "conv_id", "turn", "text", span=64)


def file_metrics(spark, sf):
    rows = with_record_columns(table(spark, sf, "pages", "page_id", "html"))
    files = rows.groupBy("basename").agg(F.sum(fn.byte_length("payload")).alias("length"))
    return corpus.file_metrics(files, clean_records(spark, sf))


def corpus_roundtrip(spark, sf):
    folder = scratch_dir(spark, "corpus")
    corpus.write_corpus(clean_records(spark, sf), folder, span=CORPUS_SPAN)
    return corpus.read_corpus(spark, folder)


def corpus_files(spark, sf):
    """One text file per archive, written with commit and abort, and read back."""
    folder = scratch_dir(spark, "corpus")
    write_corpus_files(clean_records(spark, sf), folder)
    return read_corpus_files(spark, folder)


def corpus_listing(spark, sf):
    """Bytes of the written outputs, from the file listing alone."""
    folder = scratch_dir(spark, "corpus")
    corpus.write_corpus(clean_records(spark, sf), folder, span=CORPUS_SPAN)
    return corpus_outputs(spark, folder).select("basename", "length")


def _downloads(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages", "page_id", "url", "html").select(
        fn.basename("url").alias("basename"),
        fn.byte_length("html").alias("bytes"),
        F.expr(f"timestampadd(MINUTE, page_id, {EPOCH})").alias("at"),
    )


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    pages = heavy(spark, sf, "page_id", "url", "html").withColumn("size", fn.byte_length("html"))
    kept = fn.byte_length("text") + len(RECORD_SEPARATOR)
    return clean_pages(pages, "html").select(
        fn.basename("url").alias("basename"),
        (F.col("size") - kept).alias("removed_bytes"),
        F.expr(f"timestampadd(SECOND, 90 * page_id, {EPOCH})").alias("at"),
    )


def run_totals(spark, sf):
    totals = ledger.run_totals(_downloads(spark, sf), _cleaned(spark, sf))
    return totals.select(
        *totals.columns[:4],
        fn.to_iso("start_time").alias("start_time_iso"),
        fn.to_iso("last_update").alias("last_update_iso"),
    )


def run_summary(spark, sf):
    totals = ledger.run_totals(_downloads(spark, sf), _cleaned(spark, sf))
    now = F.col("last_update") + F.expr("INTERVAL 90061 SECONDS")
    return ledger.run_summary(totals, now)


def distinct_names(spark, sf):
    return ledger.distinct_names(
        table(spark, sf, "pages", "url").select(fn.basename("url").alias("basename")),
        table(spark, sf, "documents", "source").withColumnRenamed("source", "basename"),
    )


def download_revert(spark, sf):
    events = table(spark, sf, "events", "event_id", "user_id", "event_type", "value").withColumn(
        "bytes", F.round(F.col("value") * 100).cast("bigint")
    )
    return ledger.downloads_in_effect(
        events,
        "user_id",
        "event_id",
        "bytes",
        F.col("event_type") == "purchase",
        F.col("event_type") == "error",
    )


# ---- ledger ----------------------------------------------------------------


def skip_cleaned(spark, sf):
    documents = table(spark, sf, "documents", "doc_id", "source", "n_chars")
    return manifest.skip_cleaned(documents, table(spark, sf, "labels", "doc_id"), "doc_id")


def skip_cleaned_sketch(spark, sf):
    """The same through a sketch of the ledger's names, put together from those of its batches."""
    documents = table(spark, sf, "documents", "doc_id", "source", "n_chars")
    ledger = table(spark, sf, "labels", "doc_id")
    bits = sketch.BITS_PER_NAME * max(1, ledger.count())
    batches = [sketch.key_sketch(ledger.where(F.col("doc_id") % 2 == b), bits, "doc_id") for b in (0, 1)]
    known = sketch.merged_sketches(*batches)
    return sketch.skip_cleaned_by_sketch(documents, ledger, known, bits, "doc_id")


def output_exists_skip(spark, sf):
    files = table(spark, sf, "documents", "doc_id", "n_chars").selectExpr(
        "concat('f', doc_id) AS basename", "n_chars AS length"
    )
    outputs = table(spark, sf, "conversations", "conv_id", "text").select(
        F.concat(F.lit("f"), F.col("conv_id")).alias("basename"), fn.byte_length("text").alias("length")
    )
    return corpus.finished_outputs(files, outputs)


def size_lookup(spark, sf):
    wanted = table(spark, sf, "pages", "page_id").selectExpr("page_id * 7 AS file_id")
    listing = table(spark, sf, "documents", "doc_id", "n_chars").selectExpr(
        "doc_id AS file_id",
        "CASE doc_id % 4 WHEN 0 THEN '0' WHEN 1 THEN NULL ELSE CAST(n_chars * 100000 AS STRING) END "
        "AS content_length",
    )
    found = manifest.with_sizes(wanted, listing, "file_id")
    status = manifest.size_status("content_length", 100 * 1024 * 1024, F.col("found"))
    return found.select(
        "file_id",
        F.when(F.col("found"), fn.estimated_size("content_length")).alias("size"),
        F.coalesce(status, F.lit("to_fetch")).alias("status"),
    )


def dedupe_basename(spark, sf):
    lines = table(spark, sf, "pages", "url")
    return manifest.one_path_per_basename(manifest.resolve_lines(lines, "url"))


def ledger_lookup(spark, sf):
    return ledger.lookup(
        table(spark, sf, "documents", "doc_id"),
        table(spark, sf, "labels"),
        "doc_id",
        {"quality": -1, "toxic": 0},
    )


def ledger_snapshot(spark, sf):
    """A ledger written in two appends and read back whole."""
    folder = scratch_dir(spark, "ledger")
    labels = table(spark, sf, "labels")
    for batch, rows in enumerate((labels.where("quality = 1"), labels.where("quality <> 1"))):
        rows.write.mode("overwrite").parquet(f"{folder}/batch_id={batch}")
    return spark.read.schema("doc_id BIGINT, quality INT, toxic INT, batch_id INT").parquet(folder)


def ledger_add_deltas(spark, sf):
    events = table(spark, sf, "events", "user_id", "event_type", "value").select(
        "user_id",
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("bytes"),
        F.lit(1).cast("bigint").alias("files"),
    )
    before = events.where("event_type = 'purchase'").groupBy("user_id").agg(
        F.sum("bytes").alias("bytes"), F.sum("files").alias("files")
    )
    return ledger.add_deltas(
        before, events.where("event_type <> 'purchase'"), "user_id", ["bytes", "files"]
    )


def ledger_set_latest(spark, sf):
    events = table(spark, sf, "events", "event_id", "user_id", "event_type", "props")
    return ledger.set_latest(events, "user_id", "event_id", ["event_type", "props"])


def ledger_insert_absent(spark, sf):
    done = table(spark, sf, "orders", "o_orderkey", "o_orderstatus").where("o_orderstatus = 'F'")
    new = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    return ledger.insert_absent(
        done.select(F.col("o_orderkey").alias("l_orderkey")), new, "l_orderkey"
    )


def ledger_remove(spark, sf):
    events = table(spark, sf, "events", "event_id", "user_id", "event_type")
    changes = events.where("event_type IN ('purchase', 'error')")
    return ledger.without_removed(changes, "user_id", "event_id", F.col("event_type") == "error")


def ledger_rebuild(spark, sf):
    outputs = table(spark, sf, "pages", "url").select(
        fn.output_name("/data/out", fn.basename("url")).alias("path")
    )
    known = table(spark, sf, "documents", "source").select(F.col("source").alias("basename"))
    return rebuild_ledger(outputs, known)


def state_json_roundtrip(spark, sf):
    folder = scratch_dir(spark, "state")
    names = table(spark, sf, "documents", "doc_id").select(F.col("doc_id").cast("string").alias("basename"))
    state_json.write_state_json(state_json.name_documents(names), folder)
    documents = state_json.read_state_json(
        spark, folder, state_json.TRACKER_SCHEMA, state_json.tracker_defaults()
    )
    return state_json.tracked_names(documents)


STATE_KEYS = "key BIGINT, names ARRAY<STRING>"


def state_defaults(spark, sf):
    """State documents of which some lack a key and some cannot be read, with defaults of our own."""
    folder = scratch_dir(spark, "state")
    # a document a supplier, but not a file each: there may be hundreds of thousands
    documents = table(spark, sf, "supplier", "s_suppkey").distinct().select(
        F.expr(
            "CASE s_suppkey % 4 WHEN 0 THEN concat('{\"key\": ', s_suppkey, ', \"names\": [\"a\", \"b\"]}') "
            "WHEN 1 THEN concat('{\"key\": ', s_suppkey, '}') WHEN 2 THEN '{\"names\": []}' "
            "ELSE concat('{\"key\": ', s_suppkey, ', ') END"
        ).alias("value"),
    )
    state_json.write_documents(documents, folder)
    defaults = {"key": F.lit(-1).cast("bigint"), "names": F.array(F.lit("nobody"))}
    schema = spark.createDataFrame([], STATE_KEYS).schema
    documents = state_json.read_state_json(spark, folder, schema, defaults, many_per_file=True)
    return documents.select("key", F.array_join("names", ",").alias("names"))


def fetch_local(spark, sf):
    source = _archives(spark, sf)
    layout = Layout(scratch_dir(spark, "run"))
    listing = archive_listing(spark, source)
    wanted = listing.select(F.col("basename").alias("rel_path"), "basename")
    sizes = listing.select("basename", F.col("length").cast("string").alias("content_length"))
    outcome = run_fetch(spark, wanted, layout, base_url=f"{source}/", listing=sizes)
    return outcome.join(archive_listing(spark, layout.landing), "basename", "left").select(
        "basename", "status", (outcome["bytes"] == F.col("length")).alias("whole")
    )


def stats_json_roundtrip(spark, sf):
    folder = scratch_dir(spark, "state")
    row = run_totals(spark, sf).withColumn("downloaded_warc_filenames", F.array().cast("array<string>"))
    state_json.write_state_json(row, folder)
    defaults = state_json.stats_defaults(F.lit("1970-01-01T00:00:00"))
    rows = state_json.read_state_json(spark, folder, state_json.STATS_SCHEMA, defaults)
    return rows.withColumn("n_names", F.size("downloaded_warc_filenames")).drop("downloaded_warc_filenames")


def counter_update(spark, sf):
    counters = table(spark, sf, "documents", "doc_id", "n_chars").join(
        table(spark, sf, "labels", "doc_id", "quality"), "doc_id", "left"
    )
    return counters.select("doc_id", fn.add_to_counter("quality", "n_chars").alias("total"))


# ---- whole runs and streams --------------------------------------------------


def stream_fetch(spark, sf):
    source = _archives(spark, sf)
    layout = Layout(scratch_dir(spark, "run"))
    archive_listing(spark, source).select("basename").write.text(layout.folder("manifest"))
    streams.fetch_stream(spark, layout.folder("manifest"), layout, f"{source}/").awaitTermination()
    log = read_table(spark, layout.fetch_log, FETCH_LOG_DDL)
    return log.select("basename", "status")


def clean_run(spark, sf):
    """Archives to corpus in one batch; the text of every archive in order."""
    layout = Layout(scratch_dir(spark, "run"))
    _archives(spark, sf, layout.landing)
    files = archive_listing(spark, layout.landing)
    run_batch(spark, files, layout, split_bytes=QUERY_SPLIT)
    return clean_corpus(spark, layout).select("basename", "value")


def clean_run_repeated(spark, sf):
    """The same batch twice, the second time with only half of the archives still there."""
    layout = Layout(scratch_dir(spark, "run"))
    _archives(spark, sf, layout.landing)
    files = archive_listing(spark, layout.landing)
    run_batch(spark, files, layout, "once", split_bytes=QUERY_SPLIT)
    left = files.where(F.crc32(F.col("basename").cast("binary")) % 2 == 0)
    run_batch(spark, left, layout, "once", split_bytes=QUERY_SPLIT)
    return clean_corpus(spark, layout).select("basename", "value")


class _OtherLedger(Layout):
    """The same outputs, with a ledger that is not there."""

    @property
    def ledger(self) -> str:
        return self.folder("other_ledger")


def ledger_recovered(spark, sf):
    """The ledger is lost after a run; written anew from the outputs it names the same texts."""
    layout = Layout(scratch_dir(spark, "run"))
    _archives(spark, sf, layout.landing)
    files = archive_listing(spark, layout.landing)
    run_batch(spark, files, layout, split_bytes=QUERY_SPLIT)
    lost = _OtherLedger(layout.root)
    recover_ledger(spark, lost)
    run_batch(spark, files, lost, split_bytes=QUERY_SPLIT)  # cleans nothing that has an output
    return clean_corpus(spark, lost).select("basename", "value")


def clean_run_nothing_kept(spark, sf):
    """No page is long enough: every archive is done, and the corpus reads as no rows."""
    layout = Layout(scratch_dir(spark, "run"))
    _archives(spark, sf, layout.landing)
    files = archive_listing(spark, layout.landing)
    run_batch(spark, files, layout, min_len=10**9, split_bytes=QUERY_SPLIT)
    done = ledger_rows(spark, layout).select("basename", "kept_records")
    corpus_rows = clean_corpus(spark, layout).groupBy("basename").agg(F.count("*").alias("kept_records"))
    return done.unionByName(corpus_rows)


def extract_deep(spark, sf):
    """Pages with hundreds of elements left open in what is hidden before the article."""
    pages = heavy(spark, sf, "page_id", "html")
    nav = "<nav>" + "<span>" * 600 + "menu</nav><article>"
    deep = F.replace(F.col("html"), F.lit("<article>"), F.lit(nav))
    return extract_pages(pages.select("page_id", deep.alias("payload"))).select("page_id", "text")


def pipeline_run(spark, sf):
    """The whole run from a manifest: copies, corpus, ledger and state, to the end."""
    source = _archives(spark, sf)
    layout = Layout(scratch_dir(spark, "run"))
    archive_listing(spark, source).select("basename").write.text(layout.folder("manifest"))
    run_to_end(spark, layout.folder("manifest"), layout, f"{source}/", split_bytes=QUERY_SPLIT)
    return clean_corpus(spark, layout).select("basename", "value")


def stream_counters(spark, sf):
    """Counters that the batches of both streams took from their plans while these ran."""
    source = _archives(spark, sf)
    layout = Layout(scratch_dir(spark, "run"))
    archive_listing(spark, source).select("basename").write.text(layout.folder("manifest"))
    streams.fetch_stream(spark, layout.folder("manifest"), layout, f"{source}/").awaitTermination()
    streams.clean_stream(spark, layout, files_per_batch=3).awaitTermination()
    sums = [F.sum(c).alias(c) for c in COUNTERS]
    return batch_counters(spark, layout).agg(*sums).select(
        "downloaded_files",
        "cleaned_files",
        "failed_files",
        "records",
        "text_bytes",
        (F.col("downloaded_bytes") - F.col("removed_bytes")).alias("kept_bytes"),
    )


RETRY_POLICY = retries.Retry(attempts=2)


def _faulty_source(spark: SparkSession, sf: str) -> tuple[DataFrame, str, Layout]:
    """Archives, what goes wrong with each (0: nothing, 1: cut off, 2: absent), a manifest of all."""
    good = archive_listing(spark, _archives(spark, sf)).select("path", "basename")
    bucket = F.regexp_extract("basename", "part-([0-9])", 1).cast("int")
    layout = Layout(scratch_dir(spark, "run"))
    good.select("basename").write.text(layout.folder("manifest"))
    return good.withColumn("fault", bucket % 3), scratch_dir(spark, "source"), layout


def stream_retry(spark, sf):
    """Some archives come cut off and some are absent in the first run; the second finds them whole."""
    archives, source, layout = _faulty_source(spark, sf)
    copy_archives(archives.where("fault = 0"), source)
    copy_archives(archives.where("fault = 1"), source, missing_bytes=40)
    run_to_end(spark, layout.folder("manifest"), layout, f"{source}/", split_bytes=QUERY_SPLIT)
    copy_archives(archives.where("fault > 0"), source)
    run_to_end(spark, layout.folder("manifest"), layout, f"{source}/", split_bytes=QUERY_SPLIT)
    return clean_corpus(spark, layout).select("basename", "value")


def stream_set_apart(spark, sf):
    """Archives that stay cut off or absent are tried twice in three runs, then set apart."""
    archives, source, layout = _faulty_source(spark, sf)
    copy_archives(archives.where("fault = 0"), source)
    copy_archives(archives.where("fault = 1"), source, missing_bytes=40)
    for _ in range(3):
        run_to_end(spark, layout.folder("manifest"), layout, f"{source}/", policy=RETRY_POLICY)
    apart = retry_table(spark, layout, RETRY_POLICY).select("basename", "attempts", "set_apart")
    done = ledger_rows(spark, layout).select(
        "basename", F.lit(0).cast("bigint").alias("attempts"), F.lit(False).alias("set_apart")
    )
    return apart.unionByName(done)


def retry_state(spark, sf):
    events = table(spark, sf, "events", "user_id", "event_type", "ts")
    failures = events.where("event_type IN ('error', 'view')").select(
        F.concat(F.lit("file-"), "user_id").alias("basename"),
        F.col("event_type").alias("reason"),
        (F.col("event_type") == "error").alias("counts"),
        F.col("ts").alias("at"),
    )
    state = retries.failure_state(failures, retries.Retry(attempts=12))
    now = F.lit(RETRY_NOW).cast("timestamp")
    tried = retries.due(state, now, F.lit("2000-01-01").cast("timestamp")).select(
        "basename", F.lit(True).alias("due")
    )
    return state.join(tried, "basename", "left").select(
        "basename",
        "attempts",
        "reason",
        F.unix_timestamp("last_at").alias("last_at"),
        F.unix_timestamp("next_due").alias("next_due"),
        "set_apart",
        F.coalesce("due", F.lit(False)).alias("due"),
    )


def stream_clean(spark, sf):
    layout = Layout(scratch_dir(spark, "run"))
    _archives(spark, sf, layout.landing)
    streams.clean_stream(spark, layout, files_per_batch=5).awaitTermination()
    return clean_corpus(spark, layout).select("basename", "value")


def stream_in_flight(spark, sf):
    """How many archives each batch of the stream took, with at most three admitted at a time."""
    layout = Layout(scratch_dir(spark, "run"))
    _archives(spark, sf, layout.landing)
    streams.clean_stream(spark, layout, files_per_batch=3).awaitTermination()
    batches = ledger_rows(spark, layout).groupBy("batch").agg(F.count("*").alias("files"))
    return batches.groupBy("files").agg(F.count("*").alias("batches"))


def stream_download_revert(spark, sf):
    """The download in effect of each file, from a stream of events."""
    schema = table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    folder = scratch_dir(spark, "effects")
    streams.effect_stream(
        events.where("event_type IN ('purchase', 'error')").selectExpr(
            "user_id AS key",
            "event_id AS seq",
            "CAST(round(value * 100) AS BIGINT) AS amount",
            "ts AS at",
            "CASE event_type WHEN 'error' THEN 'reverted' ELSE 'downloaded' END AS kind",
        ),
        f"{folder}/view",
        f"{folder}/checkpoint",
        delay="400 days",
    ).awaitTermination()
    view = streams.effect_view(spark, f"{folder}/view")
    return view.select(F.col("key").cast("bigint").alias("user_id"), F.col("amount").alias("bytes"))


CORES_PER_NODE = 75


def messages(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "user_id AS worker",
        "event_id AS seq",
        "concat('file-', event_id) AS filename",
        "CASE WHEN event_type IN ('view', 'click') THEN 'start' ELSE 'end' END AS status",
    )


def active_workers(spark, sf):
    events = table(spark, sf, "events", "event_id", "user_id", "event_type")
    return activity.active_workers(messages(events), CORES_PER_NODE).orderBy("worker")


def stream_active_workers(spark, sf):
    schema = table(spark, sf, "events").schema
    events = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    )
    folder = scratch_dir(spark, "activity")
    streams.active_worker_stream(
        messages(events), f"{folder}/view", f"{folder}/checkpoint", CORES_PER_NODE
    ).awaitTermination()
    return streams.active_view(spark, f"{folder}/view")


QUERIES: dict[str, Query] = {
    "scalar_collapse_ws": scalar_collapse_ws,
    "clean_run_repeated": clean_run_repeated,
    "clean_run_nothing_kept": clean_run_nothing_kept,
    "ledger_recovered": ledger_recovered,
    "extract_deep": extract_deep,
    "pipeline_run": pipeline_run,
    "manifest_resolve": manifest_resolve,
    "decode_payload": decode_payload,
    "size_rules": size_rules,
    "display_formats": display_formats,
    "iso_times": iso_times,
    "list_edits": list_edits,
    "html_filter": html_filter,
    "extract_pages": extract_all,
    "extract_pages_min_len": extract_pages_min_len,
    "extract_routes": extract_routes,
    "warc_roundtrip": warc_roundtrip,
    "warc_splits": warc_splits,
    "warc_format": warc_format,
    "pack_per_file": pack_per_file,
    "pack_conversations": pack_conversations,
    "file_metrics": file_metrics,
    "corpus_roundtrip": corpus_roundtrip,
    "corpus_files": corpus_files,
    "corpus_listing": corpus_listing,
    "run_totals": run_totals,
    "run_summary": run_summary,
    "distinct_names": distinct_names,
    "download_revert": download_revert,
    "skip_cleaned": skip_cleaned,
    "skip_cleaned_sketch": skip_cleaned_sketch,
    "output_exists_skip": output_exists_skip,
    "size_lookup": size_lookup,
    "dedupe_basename": dedupe_basename,
    "ledger_lookup": ledger_lookup,
    "ledger_snapshot": ledger_snapshot,
    "ledger_add_deltas": ledger_add_deltas,
    "ledger_set_latest": ledger_set_latest,
    "ledger_insert_absent": ledger_insert_absent,
    "ledger_remove": ledger_remove,
    "ledger_rebuild": ledger_rebuild,
    "state_json_roundtrip": state_json_roundtrip,
    "stats_json_roundtrip": stats_json_roundtrip,
    "counter_update": counter_update,
    "fetch_local": fetch_local,
    "stream_fetch": stream_fetch,
    "stream_counters": stream_counters,
    "stream_retry": stream_retry,
    "stream_set_apart": stream_set_apart,
    "retry_state": retry_state,
    "arc_read": arc_read,
    "missing_archives": missing_archives,
    "own_extractor": own_extractor,
    "state_defaults": state_defaults,
    "stream_in_flight": stream_in_flight,
    "clean_run": clean_run,
    "stream_clean": stream_clean,
    "active_workers": active_workers,
    "stream_active_workers": stream_active_workers,
    "stream_download_revert": stream_download_revert,
}
