"""For every registered query, the same result as one DuckDB statement."""

from __future__ import annotations

from pagemill.constants import RECORD_SEPARATOR
from pagemill.plans.queries import CORES_PER_NODE, CORPUS_SPAN, RETRY_NOW, ROUTE_TAGS, ROWS_PER_ARCHIVE

SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
SEP = "'" + RECORD_SEPARATOR.replace("\n", "' || chr(10) || '") + "'"
EPOCH = "TIMESTAMP '2024-01-01 00:00:00'"


def n_bytes(text: str) -> str:
    return f"octet_length(encode({text}))"


def base(path: str) -> str:
    return f"regexp_extract({path}, '([^/]+)/*$', 1)"


def collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SPACE}+', ' ', 'g'))"


def strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{SPACE}+', ''), '{SPACE}+$', '')"


def markup_text(fragment: str) -> str:
    """Tags become spaces; then the entities that occur in the pages; then white space."""
    bare = f"regexp_replace({fragment}, '<[^>]*>', ' ', 'g')"
    for entity, char in (("middot", "·"), ("copy", "©"), ("quot", '"'), ("amp", "&")):
        bare = f"regexp_replace({bare}, '&{entity};?', '{char}', 'g')"
    return collapse(bare)


ARTICLE = "regexp_extract(html, '(?s)<article>(.*)</article>', 1)"
_DROP = "(?s)<script>.*?</script>|<style>.*?</style>|<nav>.*?</nav>|<footer>.*?</footer>|<!--.*?-->"
VISIBLE = f"regexp_replace(html, '{_DROP}', ' ', 'g')"
BODY = f"regexp_extract({VISIBLE}, '(?s)<body>(.*)', 1)"

# text of every page: the article, and the body after it when the article is very short
PAGE_TEXT = f"""
  page_parts AS (SELECT page_id, url, html, {markup_text(ARTICLE)} AS article,
                        {markup_text(BODY)} AS body FROM pages),
  page_text AS (SELECT *, length(article) < 25 AS short,
                       CASE WHEN length(article) < 25 THEN trim(article || ' ' || body)
                            ELSE article END AS text FROM page_parts)"""

RECORD_COLUMNS = """
  'part-' || (page_id % 8) || '.warc.gz' AS basename, page_id AS rec_offset,
  CASE page_id % 5 WHEN 0 THEN 'request' WHEN 1 THEN 'resource' ELSE 'response' END AS rec_type,
  CASE page_id % 7 WHEN 0 THEN 'text/plain' WHEN 1 THEN 'text/HTML' WHEN 2 THEN NULL
                   ELSE 'text/html; charset=utf-8' END AS content_type"""
IS_HTML = "rec_type IN ('response', 'resource') AND coalesce(content_type, '') LIKE '%html%'"
ARCHIVE = f"'part-' || (page_id % 8) || '-' || (page_id // {8 * ROWS_PER_ARCHIVE}) || '.warc.gz'"
CLEAN = f"""{PAGE_TEXT},
  clean AS (SELECT * FROM (SELECT page_id, url, html, text, {RECORD_COLUMNS},
                                  {ARCHIVE} AS archive FROM page_text)
            WHERE {IS_HTML} AND length(text) >= 100)"""

LINES = r"""
  (SELECT page_id, CASE page_id % 6 WHEN 0 THEN '  ' || url || chr(9) WHEN 1 THEN '#' || url
     WHEN 2 THEN ' ' || chr(9) || ' ' WHEN 3 THEN '  #' || url
     WHEN 4 THEN chr(160) || url || '/' ELSE url END AS line FROM pages)"""


def size_of(text: str) -> str:
    return (
        f"CASE WHEN regexp_matches({text}, '^[0-9]+$') THEN try_cast({text} AS BIGINT) "
        "ELSE 52428800 END"
    )


def needed(size: str) -> str:
    return f"CAST(floor(CAST({size} AS DOUBLE) * CAST(1.10 AS DOUBLE)) AS BIGINT)"


def clock(seconds: str) -> str:
    return f"""CASE ({seconds}) // 86400 WHEN 0 THEN '' WHEN 1 THEN '1 day, '
        ELSE (({seconds}) // 86400) || ' days, ' END
        || printf('%d:%02d:%02d', (({seconds}) % 86400) // 3600, (({seconds}) % 3600) // 60, ({seconds}) % 60)"""


def iso(moment: str) -> str:
    return (
        f"strftime({moment}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({moment}) % 1000000 = 0 "
        f"THEN '' ELSE strftime({moment}, '.%f') END"
    )


TOTALS = f"""{PAGE_TEXT},
  downloads AS (SELECT {base('url')} AS b, arg_min({n_bytes('html')}, page_id) AS bytes,
      min({EPOCH} + page_id * INTERVAL 1 MINUTE) AS t0, max({EPOCH} + page_id * INTERVAL 1 MINUTE) AS t1
      FROM pages GROUP BY 1),
  cleaned AS (SELECT {base('url')} AS b, arg_min({n_bytes('html')} - {n_bytes('text')} - 21, page_id) AS removed,
      min({EPOCH} + page_id * INTERVAL 90 SECOND) AS t0, max({EPOCH} + page_id * INTERVAL 90 SECOND) AS t1
      FROM page_text WHERE length(text) >= 100 GROUP BY 1),
  totals AS (SELECT
      (SELECT CAST(sum(bytes) AS BIGINT) FROM downloads) AS total_data_downloaded_bytes,
      (SELECT CAST(sum(removed) AS BIGINT) FROM cleaned) AS total_data_removed_bytes,
      (SELECT count(*) FROM downloads) AS total_warc_processed_for_download_count,
      (SELECT count(*) FROM cleaned) AS total_warc_successfully_cleaned_count,
      least((SELECT min(t0) FROM downloads), (SELECT min(t0) FROM cleaned)) AS start_time,
      greatest((SELECT max(t1) FROM downloads), (SELECT max(t1) FROM cleaned)) AS last_update)"""

_ROUTES = ["article", "main", '[role="main"]', ".content", "#content", ".main-content",
           "#main-content", ".post-body", ".entry-content", ".article-body", "p", "body", "body"]


def routes() -> str:
    names = "[" + ", ".join(f"'{r}'" for r in _ROUTES) + "]"
    kind = f"page_id % {len(ROUTE_TAGS)}"
    paragraphs = markup_text(f"regexp_replace({ARTICLE}, '(?s)<h1>.*?</h1>', ' ')")
    whole = markup_text(VISIBLE)
    return f"""WITH {PAGE_TEXT},
      kinds AS (SELECT page_id, {kind} AS kind, article, body, {paragraphs} AS paragraphs,
                       {whole} AS whole FROM page_text),
      picked AS (SELECT *, CASE WHEN kind < 10 THEN article WHEN kind = 10 THEN paragraphs
                                WHEN kind = 11 THEN body ELSE whole END AS segment FROM kinds)
      SELECT page_id,
        {names}[kind + 1] || CASE WHEN kind <= 10 AND length(segment) < 25 THEN '+body' ELSE '' END AS route,
        CASE WHEN kind <= 10 AND length(segment) < 25 THEN trim(segment || ' ' || body)
             ELSE segment END AS text
      FROM picked"""


def packed(key: str, position: str, source: str, span: int, name: str) -> str:
    return f"""SELECT {key} AS {name}, {position} // {span} AS chunk, count(*) AS n_records,
      string_agg(text || {SEP}, '' ORDER BY {position}) AS packed FROM {source} GROUP BY 1, 2"""


MESSAGES = """(SELECT user_id AS worker, event_id AS seq, 'file-' || event_id AS filename,
   CASE WHEN event_type IN ('view', 'click') THEN 'start' ELSE 'end' END AS status FROM events)"""
ACTIVE = f"""SELECT worker, CASE WHEN worker < {CORES_PER_NODE} THEN 'N0' ELSE 'N1' END AS node, filename
  FROM (SELECT *, row_number() OVER (PARTITION BY worker ORDER BY seq DESC) AS n FROM {MESSAGES})
  WHERE n = 1 AND status = 'start'"""
CLEAN_VALUES = f"WITH {CLEAN} SELECT archive AS basename, text AS value FROM clean"
CORPUS_ROWS = f"WITH {CLEAN} SELECT basename, rec_offset // {CORPUS_SPAN} AS chunk, text AS value FROM clean"

DOWNLOAD_REVERT = """WITH e AS (SELECT user_id, event_id, event_type,
              CAST(round(value * 100) AS BIGINT) AS bytes FROM events),
            r AS (SELECT user_id, max(event_id) AS back FROM e WHERE event_type = 'error' GROUP BY 1)
            SELECT user_id, arg_min(bytes, event_id) AS bytes FROM e LEFT JOIN r USING (user_id)
            WHERE event_type = 'purchase' AND event_id > coalesce(back, -1) GROUP BY 1"""

_WORDS = "string_split(p_name, ' ')"


def removed_first(items: str, item: str) -> str:
    at = f"list_position({items}, {item})"
    return f"CASE WHEN {at} > 0 THEN {items}[1:{at} - 1] || {items}[{at} + 1:] ELSE {items} END"


def oracle() -> dict[str, str]:
    return {
        "scalar_collapse_ws": f"""SELECT doc_id, {collapse('text')} AS collapsed,
            length({strip('text')}) AS stripped_chars, length(text) AS n_code_points,
            {n_bytes('text')} AS n_bytes FROM documents""",
        "manifest_resolve": f"""SELECT page_id, {strip('line')} AS rel_path,
            {base(strip('line'))} AS basename,
            'https://data.commoncrawl.org/' || {strip('line')} AS url
            FROM {LINES} WHERE line NOT LIKE '#%' AND {strip('line')} <> ''""",
        "decode_payload": r"""SELECT page_id, CASE WHEN page_id % 3 = 0
            THEN regexp_replace(html, '[^\x{00}-\x{ff}]', '?', 'g') ELSE html END AS text FROM pages""",
        "size_rules": f"""WITH lengths AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN '0' WHEN 1 THEN ''
              WHEN 2 THEN NULL WHEN 3 THEN '12a' ELSE CAST(page_id * 1048576 AS VARCHAR) END AS t FROM pages),
            sizes AS (SELECT page_id, {size_of('t')} AS size FROM lengths)
            SELECT page_id, size, {needed('size')} AS needed,
              CASE WHEN {needed('size')} > 209715200 THEN 'no_capacity' ELSE 'to_fetch' END AS status
            FROM sizes WHERE size <> 0""",
        "display_formats": f"""WITH a AS (SELECT o_orderkey,
              CAST(round(o_totalprice * 1e6) AS BIGINT) AS n, CAST(floor(o_totalprice) AS BIGINT) AS s FROM orders)
            SELECT o_orderkey, printf('%.2f', n / 1073741824.0::DOUBLE) || ' GB' AS gigabytes,
              printf('%.1f', n / 1048576.0::DOUBLE) || ' MB' AS megabytes, {clock('s')} AS elapsed FROM a""",
        "iso_times": f"""WITH e AS (SELECT event_id, CASE WHEN event_id % 2 = 0
              THEN date_trunc('second', ts) ELSE ts END AS t FROM events)
            SELECT event_id, {iso('t')} AS iso, epoch_us(t) AS micros FROM e""",
        "list_edits": f"""WITH w AS (SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN {_WORDS} END AS words,
              p_brand, string_split(p_type, ' ')[1] AS item FROM part),
            d AS (SELECT *, words || words AS doubled, coalesce(words[1], item) AS again FROM w)
            SELECT p_partkey,
              array_to_string(CASE WHEN list_contains(coalesce(words, []), p_brand) THEN words
                ELSE list_append(coalesce(words, []), p_brand) END, '|') AS added,
              array_to_string(CASE WHEN list_contains(coalesce(words, []), again) THEN words
                ELSE list_append(coalesce(words, []), again) END, '|') AS added_again,
              CASE WHEN words IS NOT NULL THEN array_to_string({removed_first('doubled', 'words[1]')}, '|') END AS removed,
              CASE WHEN words IS NOT NULL THEN array_to_string({removed_first('words', 'p_brand')}, '|') END AS not_there
            FROM d""",
        "html_filter": f"SELECT * FROM (SELECT {RECORD_COLUMNS} FROM pages) WHERE {IS_HTML}",
        "extract_pages": f"""WITH {PAGE_TEXT} SELECT page_id,
            CASE WHEN short THEN 'article+body' ELSE 'article' END AS route,
            CAST(CASE WHEN short THEN 2 ELSE 1 END AS INTEGER) AS n_segments,
            length(text) AS n_chars, text FROM page_text""",
        "extract_pages_min_len": f"""WITH {PAGE_TEXT}
            SELECT page_id, url, text FROM page_text WHERE length(text) >= 100""",
        "extract_routes": routes(),
        "warc_roundtrip": f"""WITH {CLEAN}
            SELECT page_id, archive AS basename, rec_type, content_type, text FROM clean""",
        "warc_splits": f"""SELECT {ARCHIVE} AS basename, count(*) AS n_records, CAST(0 AS BIGINT) AS n_errors,
            count(*) AS n_with_headers, CAST(0 AS INTEGER) AS n_broken FROM pages GROUP BY 1""",
        "warc_format": f"WITH {CLEAN} SELECT page_id, archive AS basename, text FROM clean",
        "pack_per_file": f"WITH {CLEAN} {packed('basename', 'rec_offset', 'clean', 512, 'basename')}",
        "pack_conversations": packed("conv_id", "turn", "conversations", 64, "conv_id"),
        "file_metrics": f"""WITH {CLEAN},
            files AS (SELECT basename, CAST(sum({n_bytes('html')}) AS BIGINT) AS input_bytes
                      FROM (SELECT html, {RECORD_COLUMNS} FROM pages) GROUP BY 1),
            kept AS (SELECT basename, count(*) AS n, CAST(sum({n_bytes('text')} + 21) AS BIGINT) AS o
                     FROM clean GROUP BY 1)
            SELECT basename, input_bytes, coalesce(n, 0) AS kept_records, coalesce(o, 0) AS output_bytes,
              input_bytes - coalesce(o, 0) AS removed_bytes FROM files LEFT JOIN kept USING (basename)""",
        "corpus_roundtrip": CORPUS_ROWS,
        "corpus_files": f"WITH {CLEAN} SELECT basename, text AS value FROM clean",
        "corpus_listing": f"""WITH {CLEAN} SELECT basename,
            CAST(sum({n_bytes('text')} + 21) AS BIGINT) AS length FROM clean GROUP BY 1""",
        "run_totals": f"""WITH {TOTALS} SELECT total_data_downloaded_bytes, total_data_removed_bytes,
            total_warc_processed_for_download_count, total_warc_successfully_cleaned_count,
            {iso('start_time')} AS start_time_iso, {iso('last_update')} AS last_update_iso FROM totals""",
        "run_summary": f"""WITH {TOTALS},
            s AS (SELECT *, CAST(epoch(last_update) - epoch(start_time) AS BIGINT) + 90061 AS sec FROM totals)
            SELECT 'Elapsed Time' AS metric, {clock('sec')} AS value FROM s
            UNION ALL SELECT 'Data Downloaded', printf('%.2f', total_data_downloaded_bytes / 1073741824.0::DOUBLE) || ' GB' FROM s
            UNION ALL SELECT 'Data Removed (Est.)', printf('%.2f', total_data_removed_bytes / 1073741824.0::DOUBLE) || ' GB' FROM s
            UNION ALL SELECT 'WARCs Downloaded', CAST(total_warc_processed_for_download_count AS VARCHAR) FROM s
            UNION ALL SELECT 'WARCs Cleaned', CAST(total_warc_successfully_cleaned_count AS VARCHAR) FROM s""",
        "distinct_names": f"""SELECT {base('url')} AS basename FROM pages
            UNION SELECT source FROM documents ORDER BY 1""",
        "download_revert": DOWNLOAD_REVERT,
        "stream_download_revert": DOWNLOAD_REVERT,
        "skip_cleaned_sketch": """SELECT doc_id, source, n_chars FROM documents d
            WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
        "skip_cleaned": """SELECT doc_id, source, n_chars FROM documents d
            WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
        "output_exists_skip": f"""SELECT 'f' || doc_id AS basename, n_chars AS length FROM documents
            WHERE doc_id IN (SELECT conv_id FROM conversations WHERE {n_bytes('text')} > 100)""",
        "size_lookup": f"""WITH l AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '0' WHEN 1 THEN NULL
              ELSE CAST(n_chars * 100000 AS VARCHAR) END AS t FROM documents),
            j AS (SELECT page_id * 7 AS file_id, doc_id IS NOT NULL AS found, {size_of('t')} AS size
                  FROM pages LEFT JOIN l ON page_id * 7 = doc_id)
            SELECT file_id, CASE WHEN found THEN size END AS size,
              CASE WHEN NOT found THEN 'head_failed' WHEN size = 0 THEN 'size_zero'
                   WHEN {needed('size')} > 104857600 THEN 'no_capacity' ELSE 'to_fetch' END AS status FROM j""",
        "dedupe_basename": f"SELECT {base('url')} AS basename, min(url) AS rel_path FROM pages GROUP BY 1",
        "ledger_lookup": """SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic
            FROM documents LEFT JOIN labels USING (doc_id)""",
        "ledger_snapshot": """SELECT doc_id, quality, toxic,
            CAST(CASE WHEN quality = 1 THEN 0 ELSE 1 END AS INTEGER) AS batch_id FROM labels""",
        "ledger_add_deltas": """SELECT user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS bytes,
            count(*) AS files FROM events GROUP BY 1""",
        "ledger_set_latest": """SELECT user_id, arg_max(event_type, event_id) AS event_type,
            arg_max(props, event_id) AS props FROM events GROUP BY 1""",
        "ledger_insert_absent": """SELECT l_orderkey, l_linenumber, l_partkey FROM (
              SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS n
              FROM lineitem) WHERE n = 1
              AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
        "ledger_remove": """SELECT user_id FROM events WHERE event_type IN ('purchase', 'error')
            GROUP BY 1 HAVING arg_max(event_type, event_id) = 'purchase'""",
        "ledger_rebuild": f"""SELECT {base('url')} AS basename FROM pages
            UNION SELECT source FROM documents ORDER BY 1""",
        "state_json_roundtrip": "SELECT DISTINCT CAST(doc_id AS VARCHAR) AS basename FROM documents",
        "stats_json_roundtrip": f"""WITH {TOTALS} SELECT total_data_downloaded_bytes, total_data_removed_bytes,
            total_warc_processed_for_download_count, total_warc_successfully_cleaned_count,
            {iso('start_time')} AS start_time_iso, {iso('last_update')} AS last_update_iso,
            CAST(0 AS INTEGER) AS n_names FROM totals""",
        "counter_update": """SELECT doc_id, coalesce(quality, 0) + n_chars AS total
            FROM documents LEFT JOIN labels USING (doc_id)""",
        "stream_fetch": f"SELECT DISTINCT {ARCHIVE} AS basename, 'downloaded' AS status FROM pages",
        "fetch_local": f"""SELECT DISTINCT {ARCHIVE} AS basename, 'downloaded' AS status, true AS whole FROM pages""",
        "arc_read": f"""WITH {PAGE_TEXT} SELECT page_id, archive AS basename, 'response' AS rec_type, text
            FROM (SELECT page_id, text, {RECORD_COLUMNS}, {ARCHIVE} AS archive FROM page_text)
            WHERE coalesce(content_type, '') LIKE '%html%' AND length(text) >= 100""",
        "missing_archives": f"""SELECT DISTINCT {ARCHIVE} AS basename,
            CASE WHEN page_id % 8 % 3 = 1 THEN 'missing' END AS reason FROM pages""",
        "own_extractor": f"""SELECT basename, rec_offset, text, 'own' AS route FROM (
                SELECT {RECORD_COLUMNS}, regexp_replace(html, '<[^>]*>', '|', 'g') AS text FROM pages)
            WHERE {IS_HTML} AND length(text) >= 100""",
        "state_defaults": """SELECT CAST(CASE WHEN s_suppkey % 4 < 2 THEN s_suppkey ELSE -1 END AS BIGINT) AS key,
            CASE s_suppkey % 4 WHEN 0 THEN 'a,b' WHEN 2 THEN '' ELSE 'nobody' END AS names FROM supplier""",
        "stream_in_flight": f"""
            WITH a AS (SELECT count(DISTINCT {ARCHIVE}) AS n FROM pages)
            SELECT CAST(3 AS BIGINT) AS files, n // 3 AS batches FROM a WHERE n >= 3
            UNION ALL SELECT n % 3, CAST(1 AS BIGINT) FROM a WHERE n % 3 > 0""",
        "clean_run": CLEAN_VALUES,
        "pipeline_run": CLEAN_VALUES,
        "clean_run_repeated": CLEAN_VALUES,
        "ledger_recovered": CLEAN_VALUES,
        "clean_run_nothing_kept": f"SELECT DISTINCT {ARCHIVE} AS basename, CAST(0 AS BIGINT) AS kept_records FROM pages",
        "extract_deep": f"WITH {PAGE_TEXT} SELECT page_id, text FROM page_text",
        "stream_clean": CLEAN_VALUES,
        "stream_counters": f"""
            WITH {CLEAN}, a AS (SELECT count(DISTINCT {ARCHIVE}) AS n FROM pages), t AS (
                SELECT count(*) AS records,
                       CAST(coalesce(sum({n_bytes("text")} + {n_bytes(SEP)}), 0) AS BIGINT) AS text_bytes FROM clean
            )
            SELECT n AS downloaded_files, n AS cleaned_files, CAST(0 AS BIGINT) AS failed_files, records,
                   text_bytes, text_bytes AS kept_bytes FROM a, t""",
        "stream_retry": CLEAN_VALUES,
        "stream_set_apart": f"""SELECT DISTINCT {ARCHIVE} AS basename,
            CAST(CASE WHEN page_id % 8 % 3 > 0 THEN 2 ELSE 0 END AS BIGINT) AS attempts,
            page_id % 8 % 3 > 0 AS set_apart FROM pages""",
        "retry_state": f"""
            WITH f AS (
                SELECT 'file-' || user_id AS basename, event_type, ts FROM events
                WHERE event_type IN ('error', 'view')
            ), s AS (
                SELECT basename, count_if(event_type = 'error')::BIGINT AS attempts,
                       max({{'at': ts, 'reason': event_type}}) AS last
                FROM f GROUP BY basename
            ), d AS (
                SELECT *, last.at + to_seconds(CAST(least(3600, 60 * pow(2, greatest(attempts - 1, 0))) AS INT))
                           AS next_due
                FROM s
            )
            SELECT basename, attempts, last.reason AS reason, CAST(floor(epoch(last.at)) AS BIGINT) AS last_at,
                   CAST(floor(epoch(next_due)) AS BIGINT) AS next_due, attempts >= 12 AS set_apart,
                   attempts < 12 AND next_due <= TIMESTAMP '{RETRY_NOW}' AS due
            FROM d""",
        "active_workers": ACTIVE + " ORDER BY worker",
        "stream_active_workers": ACTIVE,
    }
