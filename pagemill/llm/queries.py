"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import langid, store, warc_zstd
from pagemill.llm.lexical import rank_documents
from pagemill.llm.line_dedup import remove_shared_lines
from pagemill.llm.lsh_search import lsh_top_k
from pagemill.llm.mixing import mix
from pagemill.llm.near_dup import near_duplicates
from pagemill.llm.packing import pack
from pagemill.llm.periodic import periodic_runs
from pagemill.llm.pii import pseudonymised
from pagemill.llm.pivot_search import pivot_top_k
from pagemill.llm.substring import remove_repeats
from pagemill.llm.token_files import read_shards, write_shards

Query = Callable[[SparkSession, str], DataFrame]


def pseudonym_key(spark: SparkSession) -> str:
    """The key of the session's setting; without it, one that is good for trial runs only."""
    return spark.conf.get("spark.pagemill.pseudonym.key", "trial")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = pack(_table(spark, sf, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_warc_zstd(spark: SparkSession, sf: str) -> DataFrame:
    archives = warc_zstd.write_pages(_table(spark, sf, "pages"), store.folder(spark, "warc-zstd"))
    return warc_zstd.pages_of(warc_zstd.read_archives(archives), archives)


def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf, "documents"))
    return kept.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2("kept_text", 256).alias("kept_sha256"),
        F.size("spans").alias("n_spans"),
    )


def op4_mixing(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents").select("doc_id", "text", "source")
    return mix(documents).select("doc_id", "size", "source_size", "target", "taken")


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    model = langid.train(documents.select("doc_id", "text", "lang"), ~langid.held_out())
    return langid.predict(documents.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score"
    )


def op6_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return pivot_top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op7_approximate_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return lsh_top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op8_pseudonyms(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents").select("doc_id", "text")
    return pseudonymised(documents, pseudonym_key(spark), count="n_replaced")


def op9_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(_table(spark, sf, "documents")).drop("text_hash")


def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return read_shards(write_shards(_table(spark, sf, "documents"), store.folder(spark, "tokens")))


def op11_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return rank_documents(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = remove_shared_lines(_table(spark, sf, "documents"))
    return kept.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def _with_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, text; a tenth of the documents, by a hash of the id, repeats some of its own words."""
    words = F.regexp_extract_all("text", F.lit("([^ \\t-\\r]+)"), F.lit(1))
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = documents.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    # of the n words those from a on repeat the p words at a
    rows = rows.withColumn("n", F.size("words")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.expr("IF(n > 0, g % n, 0)"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr(
        "array_join(concat(slice(words, 1, CAST(a AS INT)), slice(flatten(array_repeat("
        "slice(words, CAST(a + 1 AS INT), CAST(p AS INT)), CAST((n - a) div p + 1 AS INT))), "
        "1, CAST(n - a AS INT))), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic_runs(_with_repeats(_table(spark, sf, "documents")))
    longest = F.expr(
        "aggregate(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>), (b, r) -> "
        "IF(b IS NULL OR r.length * b.period > b.length * r.period, r, b))"
    )
    listed = F.expr(
        "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    )
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_warc_zstd,
        op3_substring_dedup,
        op4_mixing,
        op5_language_id,
        op6_exact_top_k,
        op7_approximate_neighbours,
        op8_pseudonyms,
        op9_near_duplicates,
        op10_token_files,
        op11_lexical_search,
        op12_line_dedup,
        op13_periodic_runs,
    )
}

# those that SQL can express; tests/llm compares the others with brute-force versions
ORACLE_SQL: dict[str, str] = {
    "op2_warc_zstd": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
        ), d AS (
            SELECT page_id, octet_length(b) AS n, sha1(b) AS h,
                   min(page_id) OVER (PARTITION BY sha1(b)) AS first_id
            FROM p
        )
        SELECT page_id, n AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT)
                       >> CAST(15 - 5 * (i % 4) AS INT)) % 32 + 1, 1)), '') AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM d
    """,
    "op3_substring_dedup": r"""
        WITH w AS MATERIALIZED (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS ws FROM documents
        ), windows AS (
            SELECT doc_id, p, array_to_string(ws[p:p + 34], ' ') AS s
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS p FROM w)
        ), repeated AS (
            SELECT doc_id, p FROM (
                SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS n FROM windows) WHERE n > 1
        ), covered AS (
            SELECT DISTINCT doc_id, p + k AS p
            FROM repeated, (SELECT unnest(range(0, 35)) AS k)
        ), runs AS (
            SELECT c.doc_id, count(*) AS n_removed,
                   count_if(NOT EXISTS (
                       SELECT 1 FROM covered b WHERE b.doc_id = c.doc_id AND b.p = c.p - 1)) AS n_spans
            FROM covered c GROUP BY c.doc_id
        ), kept AS (
            SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS kept
            FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w) x
            ANTI JOIN covered c ON x.doc_id = c.doc_id AND x.p = c.p
            GROUP BY x.doc_id
        )
        SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
               coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256,
               CAST(coalesce(n_spans, 0) AS INT) AS n_spans
        FROM w LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op6_exact_top_k": """
        WITH v AS MATERIALIZED (
            SELECT DISTINCT vec_id,
                   list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        ), r AS (
            SELECT query_id, vec_id, score, CAST(row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op11_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
            FROM documents
        ), i AS (
            SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
            FROM benchmark
        ), c AS (
            SELECT count(*) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0
        ), it AS (SELECT i, item_id, unnest(t) AS term FROM i
        ), dt AS (
            SELECT d, doc_id, len(t) AS n, unnest(t) AS term FROM d
        ), tf AS (
            SELECT d, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
            FROM dt WHERE term IN (SELECT term FROM it) GROUP BY d, term
        ), w AS (
            SELECT term, CAST(floor(1000 * ln((2 * c.n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM tf, c GROUP BY term, c.n
        ), s AS (
            SELECT i, any_value(item_id) AS item_id, d, any_value(doc_id) AS doc_id,
                   CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * tf.n * c.n) // c.l)))) AS BIGINT)
                       AS score
            FROM it JOIN tf USING (term) JOIN w USING (term), c GROUP BY i, d
        ), r AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank
            FROM s WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
    """,
    "op12_line_dedup": r"""
        WITH l AS MATERIALIZED (
            SELECT d, doc_id, line, i, translate(regexp_replace(line, '^[ \t-\r]+|[ \t-\r]+$', '', 'g'),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
            FROM (SELECT d, doc_id, unnest(t) AS line, unnest(range(len(t))) AS i
                  FROM (SELECT row_number() OVER () AS d, doc_id,
                               string_split(coalesce(text, ''), chr(10)) AS t FROM documents))
        ), often AS (
            SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40
            GROUP BY k HAVING count(DISTINCT d) >= 5
        ), m AS (
            SELECT d, doc_id, line, i,
                   often.k IS NOT NULL AND doc_id IS DISTINCT FROM last AS dropped
            FROM l LEFT JOIN often USING (k)
        )
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count_if(dropped)::BIGINT AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), ''))
                   AS kept_sha256
        FROM m GROUP BY d
    """,
    # equal words at a distance q, in a row: all stretches with period q; the smallest q is the run's
    "op13_periodic_runs": r"""
        WITH t AS (
            SELECT row_number() OVER () AS d, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS ws,
                   xor(list_reduce(
                       list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                       lambda c, x: list_reduce(
                           [0, 0, 0, 0, 0, 0, 0, 0], lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(c, x)),
                       4294967295), 4294967295) AS h
            FROM documents
        ), u AS (
            SELECT *, len(ws) AS n, h // 10 AS g FROM t
        ), v AS (
            SELECT *, h % 10 = 0 AND n > 0 AS changed, g % greatest(n, 1) AS a FROM u
        ), y AS (
            SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM v
        ), w AS MATERIALIZED (
            SELECT d, n, unnest(range(n)) AS i, unnest(list_transform(range(n), lambda i:
                       ws[1 + CASE WHEN changed AND i >= a THEN a + (i - a) % p ELSE i END])) AS word
            FROM y
        ), e AS (
            SELECT x.d, z.i - x.i AS q, x.i
            FROM w x JOIN w z ON x.d = z.d AND x.word = z.word AND z.i > x.i AND z.i - x.i <= x.n // 4
        ), stretches AS (
            SELECT d, q, min(i) AS s, count(*) + q AS len
            FROM (SELECT *, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS island FROM e)
            GROUP BY d, q, island HAVING count(*) + q >= greatest(6, 4 * q)
        ), runs AS MATERIALIZED (
            SELECT d, s, len, min(q) AS q FROM stretches GROUP BY d, s, len
        ), best AS (
            SELECT d, s, len, q FROM (
                SELECT *, row_number() OVER (PARTITION BY d ORDER BY len::DOUBLE / q DESC, s, q) AS k FROM runs)
            WHERE k = 1
        ), listed AS (
            SELECT d, count(*) AS n_runs,
                   string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS all_runs
            FROM runs GROUP BY d
        ), kept AS (
            SELECT d, string_agg(word, ' ' ORDER BY i) AS text FROM w
            WHERE NOT EXISTS (
                SELECT 1 FROM runs r WHERE r.d = w.d AND w.i >= r.s + r.q AND w.i < r.s + r.len)
            GROUP BY d
        )
        SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, len AS length, q AS period,
               CAST((1000 * len) // q AS BIGINT) AS exponent_milli,
               sha256(coalesce(all_runs, '')) AS runs_sha256,
               sha256(coalesce(kept.text, '')) AS collapsed_sha256
        FROM t LEFT JOIN listed USING (d) LEFT JOIN best USING (d) LEFT JOIN kept USING (d)
    """,
}
