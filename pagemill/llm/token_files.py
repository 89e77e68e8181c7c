"""All documents as token ids in files that answer access, count and occurrence lookups.

The ids of all documents, one after another in ascending doc_id order, are cut
every SHARD_TOKENS: shard s holds positions s * SHARD_TOKENS and up, so the file
of a position is known without a directory, and a document longer than a shard
lies in several. Each shard is one wavelet-matrix file (wavelet.py).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagemill.llm import store
from pagemill.llm.tokens import crc32, encoded_rows, shifted_crc32, vocabulary_path
from pagemill.llm.wavelet import WaveletFile, encode

SHARD_TOKENS = 1 << 20
STAGED_TOKENS = 1 << 22  # ids in one staged file
NO_ID = np.iinfo(np.int64).min  # stands for a null doc_id in a document table


def _staged(documents: DataFrame, path: str, place: str) -> DataFrame:
    """Ids in staged files; a row a document: doc_id, file, position and length there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, held = [], [], 0

        def flushed() -> pa.RecordBatch:
            narrow = max(int(x.max()) for x in ids) < 1 << 16
            flat = np.concatenate(ids).astype("<u2" if narrow else "<u4")
            data = zstandard.ZstdCompressor(level=1).compress(flat.data)
            file = store.write_file(place, b"\2" if narrow else b"\4", data)
            lengths = np.array([len(x) for x in ids])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k["doc_id"] for k in keys], pa.int64()),
                    pa.array([k["text_hash"] for k in keys], pa.int64()),
                    pa.array([file] * len(keys)),
                    pa.array(np.cumsum(lengths) - lengths),
                    pa.array(lengths),
                ],
                ["doc_id", "text_hash", "file", "begin", "n_tokens"],
            )

        for key, doc in encoded_rows(batches, path):
            keys.append(key)
            ids.append(doc)
            held += len(doc)
            if held >= STAGED_TOKENS:
                yield flushed()
                keys, ids, held = [], [], 0
        if keys:
            yield flushed()
        del keys, ids
        store.give_back()

    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"))
    return documents.select(key.alias("key"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, text_hash long, file string, begin long, n_tokens long"
    )


def _with_starts(rows: DataFrame, purpose: str, tasks: int) -> DataFrame:
    """Adds `start`: the tokens of all rows before each, by doc_id (nulls first), then text hash.

    Ranges of the order are summed first; their running sums are a row a range.
    """
    order = ["doc_id", "text_hash", "file", "begin"]
    ranged = store.written(
        rows.repartitionByRange(tasks, *order).withColumn("range", F.spark_partition_id()),
        purpose,
    )
    sums = ranged.groupBy("range").agg(F.sum("n_tokens").alias("tokens"))
    before = sums.select(
        "range",
        (F.sum("tokens").over(Window.orderBy("range")) - F.col("tokens")).alias("before"),
    )
    within = Window.partitionBy("range").orderBy(*order)
    return (
        ranged.join(before, "range")
        .withColumn("start", F.col("before") + F.sum("n_tokens").over(within) - F.col("n_tokens"))
        .drop("range", "before")
    )


def write_shards(
    documents: DataFrame,
    place: str,
    vocabulary: str | None = None,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Write the files; one row a shard: shard, path.

    A null or empty text is its end id alone; rows with one doc_id are ordered
    by a hash of the text; a null doc_id comes first. No rows make no files.
    Tables in a shard have per piece: doc_id, the document's start, its number of
    ids, and the piece's first position (both counted over all documents).
    """
    path = vocabulary or vocabulary_path()
    spark = documents.sparkSession
    tasks = 8 * spark.sparkContext.defaultParallelism
    staged = store.written(_staged(documents, path, f"{place}/staged"), "token-lists")
    placed = store.written(_with_starts(staged, "token-lengths", tasks), "token-starts")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, flat = None, None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.file != name:
                    data = store.read_file(row.file)
                    flat = zstandard.ZstdDecompressor().decompress(data[1:])
                    name, flat = row.file, np.frombuffer(flat, f"<u{data[0]}")
                ids = flat[row.begin : row.begin + row.n_tokens]
                at = row.start
                while at < row.start + row.n_tokens:
                    end = min(row.start + row.n_tokens, (at // shard_tokens + 1) * shard_tokens)
                    piece = ids[at - row.start : end - row.start].astype("<u4")
                    if piece.max() < 1 << 16:
                        piece = piece.astype("<u2")
                    width = bytes([piece.itemsize])
                    data = width + piece.tobytes()
                    shard = at // shard_tokens
                    out.append((shard, at, row.doc_key, row.start, row.n_tokens, data))
                    at = end
            columns = ["shard", "position", "doc_key", "start", "n_tokens", "ids"]
            yield pd.DataFrame(out, columns=columns)

    def build(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position")
        parts = [np.frombuffer(x, f"<u{x[0]}", offset=1) for x in rows["ids"]]
        keys = [NO_ID if k is None else int(k) for k in rows["doc_key"]]
        table = np.column_stack([keys, rows["start"], rows["n_tokens"], rows["position"]])
        file = store.write_file(place, encode(np.concatenate(parts), table.astype("<i8")))
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "path": [file]})

    # as text: pandas would turn a null beside integers into a float
    by_file = placed.withColumn("doc_key", F.col("doc_id").cast("string"))
    cut = (
        by_file.repartition(tasks, "file")
        .sortWithinPartitions("file", "begin")
        .mapInPandas(
            pieces,
            "shard long, position long, doc_key string, start long, n_tokens long, ids binary",
        )
    )
    made = cut.groupBy("shard").applyInPandas(build, "shard long, path string")
    return store.written(made, "token-shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32.

    A document in several shards gets its CRC from those of its pieces.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                shard = WaveletFile(store.read_file(path))
                ids, table = shard.all(), shard.documents
                ends = np.append(table[1:, 3], table[0, 3] + len(ids))
                rows = []
                for (key, start, n, at), end in zip(table.tolist(), ends.tolist()):
                    crc = crc32(ids[at - table[0, 3] : end - table[0, 3]])
                    crc = shifted_crc32(crc, 4 * (start + n - end))
                    rows.append((None if key == NO_ID else str(key), start, n, crc))
                yield pd.DataFrame(rows, columns=["doc_key", "start", "n_tokens", "crc"])

    parts = store.dealt(shards.select("path")).mapInPandas(
        run, "doc_key string, start long, n_tokens long, crc long"
    )
    return (
        parts.groupBy("doc_key", "start", "n_tokens")
        .agg(F.bit_xor("crc").alias("ids_crc32"))
        .select(F.col("doc_key").cast("long").alias("doc_id"), "start", "n_tokens", "ids_crc32")
    )
