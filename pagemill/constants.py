"""Values that outputs depend on. All of them are fixed: changing one changes results."""

# Defaults of a run.
BASE_URL = "https://data.commoncrawl.org/"
MIN_TEXT_LENGTH = 100
RECORD_SEPARATOR = "\n\n---EndOfRecord---\n\n"
UNKNOWN_SIZE_BYTES = 50 * 1024 * 1024
CAPACITY_FACTOR = 1.10
COPY_CHUNK_BYTES = 1024 * 1024
SAVE_INTERVAL_SECONDS = 15
FILES_IN_FLIGHT = 12
OUTPUT_SUFFIX = ".txt"

# Elements removed with everything inside them.
DROPPED_TAGS = frozenset(
    """script style noscript meta link header footer nav aside form button input
    select textarea iframe embed object applet figure figcaption canvas svg path
    video audio""".split()
)

# Where main content is looked for, best first.
# (what to compare, value to compare it with, label of the route)
CONTENT_SELECTORS = (
    ("tag", "article", "article"),
    ("tag", "main", "main"),
    ("role", "main", '[role="main"]'),
    ("class", "content", ".content"),
    ("id", "content", "#content"),
    ("class", "main-content", ".main-content"),
    ("id", "main-content", "#main-content"),
    ("class", "post-body", ".post-body"),
    ("class", "entry-content", ".entry-content"),
    ("class", "article-body", ".article-body"),
)
FALLBACK_SHARE = 0.25

# The keys of the two state documents.
STATS_COUNTERS = (
    "total_data_downloaded_bytes",
    "total_data_removed_bytes",
    "total_warc_processed_for_download_count",
    "total_warc_successfully_cleaned_count",
)
STATS_TIMES = ("start_time_iso", "last_update_iso")
STATS_NAMES = "downloaded_warc_filenames"
TRACKER_NAMES = "cleaned_warc_basenames"
