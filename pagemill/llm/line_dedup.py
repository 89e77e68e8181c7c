"""Lines that many documents share, dropped from all but one of them.

(1) Documents go to chunk files; each chunk gives a row for each distinct long line of it:
hash, documents in the chunk, largest document. (2) Rows are summed by hash. What
occurs in one document only needs no entry; the other hashes are dealt into
shards, each a minimal perfect hash that indexes arrays of fingerprints, counts and
largest documents (perfect_hash.py), one file. (3) The chunks' hashes go to the shards and
probe the arrays; only hits go back. (4) Chunks are read again and give the texts.
Neither step holds more than a chunk or a shard, and a line in every
document is one row a chunk.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm import chunks as ch
from pagemill.llm import store
from pagemill.llm.perfect_hash import PerfectIndex

MIN_CHARS = 40  # code points of a key that may be dropped
MIN_DOCUMENTS = 5
CHUNK_BYTES = 8 << 20  # of text: a task needs about ten times as much memory
SHARD_KEYS = 1 << 20  # hashes in one shard: about 20 MB

_SPACE = b" \t\n\x0b\x0c\r"
_NO_ID = np.iinfo(np.int64).min  # a null doc_id: the smallest
_LINES_DDL = "chunk string, h1 long, h2 long, documents long, largest long"


def long_lines(text: bytes, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(line number, digest of the key) of each line whose key is long enough."""
    for i, line in enumerate(text.split(b"\n")):
        if len(line) >= min_chars:
            key = line.strip(_SPACE).lower()
            if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                yield i, xxhash.xxh3_128_digest(key)


def _hashes(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _lines(chunks: DataFrame, min_chars: int) -> DataFrame:
    """A row for each distinct long line of a chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["chunk"]:
                chunk = ch.Chunk(name)
                many: Counter[bytes] = Counter()
                largest: dict[bytes, int] = {}
                for key, text in zip(chunk.ids, chunk.texts):
                    found = {digest for _, digest in long_lines(text, min_chars)}
                    many.update(found)
                    number = _NO_ID if key is None else key
                    for digest in found:
                        largest[digest] = max(number, largest.get(digest, _NO_ID))
                h1, h2 = _hashes(list(many))
                yield pd.DataFrame(
                    {
                        "chunk": name,
                        "h1": h1,
                        "h2": h2,
                        "documents": np.fromiter(many.values(), np.int64, len(many)),
                        "largest": np.fromiter(map(largest.get, many), np.int64, len(many)),
                    }
                )
        store.give_back()

    return store.written(store.dealt(chunks.select("chunk")).mapInPandas(run, _LINES_DDL), "lines")


def _index(lines: DataFrame, place: str, shard_keys: int) -> tuple[DataFrame, int]:
    """(shard, path of its file; number of shards) over the lines that two documents or more have."""
    counted = store.written(
        lines.groupBy("h1", "h2")
        .agg(F.sum("documents").alias("documents"), F.max("largest").alias("largest"))
        .where("documents > 1"),
        "line-counts",
    )
    shards = max(1, -(-counted.count() // shard_keys))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        index = PerfectIndex.build(
            rows["h1"].to_numpy().view(np.uint64),
            rows["h2"].to_numpy().view(np.uint64),
            rows["documents"].to_numpy(),
            rows["largest"].to_numpy(),
        )
        path = store.write_file(place, index.to_bytes())
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "path": [path]})

    files = (
        counted.withColumn("shard", F.pmod("h1", F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(build, "shard long, path string")
    )
    return store.written(files, "line-shards"), shards


def _hits(lines: DataFrame, index: DataFrame, shards: int, min_documents: int) -> DataFrame:
    """Per chunk, its lines that `min_documents` or more have: chunk, hits(h1, h2, largest)."""

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, shard = None, None
        for batch in batches:
            for wanted, rows in batch.groupby("path", sort=False):
                if wanted != path:
                    path, shard = wanted, PerfectIndex.from_bytes(store.read_file(wanted))
                a, b = (rows[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
                known, counts, values = shard.find(a, b)
                often = counts >= min_documents
                yield rows[known][often][["chunk", "h1", "h2"]].assign(largest=values[often])
        store.give_back()

    # a shard is probed by several tasks if there are fewer shards than tasks
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("chunk"), F.lit(max(1, 2 * tasks // shards)))
    found = (
        lines.select("chunk", "h1", "h2", F.pmod("h1", F.lit(shards)).alias("shard"))
        .join(index, "shard")
        .select("chunk", "h1", "h2", "shard", "path")
        .repartition("shard", part)
        .sortWithinPartitions("shard")
        .select("chunk", "h1", "h2", "path")
        .mapInPandas(probe, "chunk string, h1 long, h2 long, largest long")
    )
    return found.groupBy("chunk").agg(F.collect_list(F.struct("h1", "h2", "largest")).alias("hits"))


def remove_shared_lines(
    documents: DataFrame,
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
    chunk_bytes: int = CHUNK_BYTES,
    shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_text.

    A text is split at \\n; a null or empty one is one empty line. A line's key is the line
    without `[\\x20\\x09-\\x0D]` at both ends and with A-Z in lower case. Lines whose key has
    at least `min_chars` code points and is found in at least `min_documents` documents go, but
    for those of the largest doc_id that has the key. A document is a row: repeated rows and ids
    count each, and all rows with that doc_id keep the line. A null id is smaller
    than any other. kept_text: the other lines joined by \\n; empty if none is left. A
    document is never cut: a task holds a whole one, whatever its length. Other columns are not read.
    """
    place = store.folder(documents.sparkSession, "lines")
    chunks = ch.write_chunks(documents, place, chunk_bytes)
    lines = _lines(chunks, min_chars)
    index, shards = _index(lines, place, shard_keys)
    jobs = chunks.select("chunk").join(_hits(lines, index, shards, min_documents), "chunk", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                kept_in = {
                    np.array([x["h1"], x["h2"]], "<i8").tobytes(): x["largest"] for x in row["hits"] or []
                }
                chunk = ch.Chunk(row["chunk"])
                out: dict[str, list] = {k: [] for k in schema.names}
                for key, text in zip(chunk.ids, chunk.texts):
                    number = _NO_ID if key is None else key
                    gone = {
                        i
                        for i, digest in (long_lines(text, min_chars) if kept_in else ())
                        if kept_in.get(digest, number) != number
                    }
                    kept = text
                    if gone:
                        kept = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in gone)
                    out["doc_id"].append(key)
                    out["n_lines"].append(text.count(b"\n") + 1)
                    out["n_dropped"].append(len(gone))
                    out["kept_text"].append(kept.decode())
                whole = pa.RecordBatch.from_pydict(out, schema=schema)
                for at in range(0, len(whole), 1000):
                    yield whole.slice(at, 1000)
        store.give_back()

    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_text", pa.string())]
    )
    return store.dealt(jobs).mapInArrow(
        run, "doc_id long, n_lines long, n_dropped long, kept_text string"
    )
