"""Exact repeats of word sequences across and within documents, and their removal.

Anchors are blocks of B = (window + 1) // 2 consecutive words at multiples of B
in each document. Any window of `window` words contains a whole block of its own
document, and where the window repeats, that block's words occur at a rolling
position of the other place. So (1) blocks are indexed by hash and every rolling
window of B words probes the index; (2) around each block that was hit, the
windows that contain it are compared, by 128-bit hashes, with those around all
other hit blocks; (3) windows found again elsewhere, joined where they
overlap, are the maximal exact repeats.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from pagemill.llm import chunks as ch
from pagemill.llm import store

WINDOW = 35


def block_words(window: int) -> int:
    return (window + 1) // 2


def _block_of_window(bounds: np.ndarray, window: int) -> np.ndarray:
    """For each word, the first block at or after it in its document."""
    block = block_words(window)
    counts = np.diff(bounds)
    first = np.repeat(bounds[:-1], counts)
    inside = np.arange(bounds[-1]) - first
    return first + -(-inside // block) * block


def repeats(
    documents: DataFrame, window: int = WINDOW, chunk_bytes: int = ch.CHUNK_BYTES
) -> tuple[DataFrame, DataFrame]:
    """(chunks, spans): chunk files of the documents, and per chunk a file of repeated words.

    Spans: chunk, spans (path of a file that has, per chunk, a mask over its words).
    """
    spark = documents.sparkSession
    place = store.folder(spark, "repeats")
    chunks = ch.write_chunks(documents, place, chunk_bytes)
    buckets = ch.buckets_for(chunks)
    block = block_words(window)

    def probes(name: str) -> tuple[ch.Chunk, list[np.ndarray], np.ndarray, tuple]:
        chunk = ch.Chunk(name)
        words, bounds = chunk.word_hashes(2)
        rolling = ch.windows(words[0], bounds, block)
        is_block = (_block_of_window(bounds, window) == np.arange(len(rolling))) & (rolling != 0)
        distinct, index, count = np.unique(rolling, return_inverse=True, return_counts=True)
        skip = int(len(distinct) > 0 and distinct[0] == 0)
        blocks = np.zeros(len(distinct), bool)
        blocks[index[is_block]] = True
        return chunk, words, bounds, (distinct, index, count, blocks, skip)

    def send_probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["chunk"]:
                *_, (distinct, _, count, blocks, skip) = probes(name)
                flags = (blocks * 1 + (count > 1) * 2).astype(np.uint8)
                yield ch.sent(name, distinct[skip:], buckets, 4, flags=flags[skip:])

    def hits(group: np.ndarray, flags: np.ndarray) -> np.ndarray:
        n = group.max() + 1
        places = np.bincount(group, weights=1 + (flags >> 1), minlength=n)
        indexed = np.zeros(n, bool)
        indexed[group[flags & 1 > 0]] = True
        return ((places > 1) & indexed)[group]

    found = ch.answered(
        store.dealt(chunks.select("chunk")).mapInPandas(
            send_probes, "bucket long, chunk string, hashes binary, flags binary"
        ),
        4,
        {"flags": "u1"},
        hits,
    )

    def candidates(name: str, hit: np.ndarray) -> dict[str, np.ndarray]:
        """Windows around hit blocks: their words' positions, two hashes."""
        _, words, bounds, (_, index, _, _, skip) = probes(name)
        hit = np.concatenate([np.zeros(skip, bool), hit])[index]
        anchor = _block_of_window(bounds, window)
        at = np.flatnonzero(ch.starts_window(bounds, window))
        at = at[hit[anchor[at]]]
        return {
            "at": at,
            "h1": ch.windows(words[0], bounds, window, 0)[at],
            "h2": ch.windows(words[1], bounds, window, 1)[at],
            "n_words": np.array([len(words[0])]),
        }

    def distinct_pairs(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, ...]:
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        new = new[: len(a)]
        number = np.cumsum(new) - 1
        index = np.empty(len(a), np.int64)
        index[order] = number
        return a[new], b[new], index, np.bincount(number, minlength=int(new.sum()))

    def extend(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        name = rows["chunk"].iloc[0]
        found = candidates(name, ch.gathered(rows, "?"))
        if not len(found["at"]):
            return pd.DataFrame(columns=["bucket", "chunk", "hashes", "second", "many", "file"])
        a, b, index, count = distinct_pairs(found["h1"], found["h2"])
        out = io.BytesIO()
        np.savez_compressed(out, at=found["at"], index=index, n_words=found["n_words"])
        frame = ch.sent(name, a, buckets, 8, second=b, many=(count > 1).astype(np.uint8))
        frame["file"] = store.write_file(place, out.getvalue())
        return frame

    # few bytes, much work: a number of tasks that follows the chunks, which Spark does not merge
    tasks = max(4 * spark.sparkContext.defaultParallelism, chunks.count() // 4)
    around = store.written(
        found.repartition(tasks, "chunk").groupBy("chunk").applyInPandas(
            extend,
            "bucket long, chunk string, hashes binary, second binary, many binary, file string",
        ),
        "repeat-windows",
    )

    def again(group: np.ndarray, second: np.ndarray, many: np.ndarray) -> np.ndarray:
        order = np.lexsort((second, group))
        g, s = group[order], second[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])])
        number = np.cumsum(new) - 1
        places = np.bincount(number, weights=1 + many[order])
        out = np.empty(len(g), bool)
        out[order] = (places > 1)[number]
        return out

    repeated = ch.answered(around.drop("file"), 8, {"second": "<u8", "many": "u1"}, again)

    def spans(_: tuple, answers: pd.DataFrame, files: pd.DataFrame) -> pd.DataFrame:
        if not len(answers) or not len(files):
            return pd.DataFrame(columns=["chunk", "spans"])
        held = np.load(io.BytesIO(store.read_file(files["file"].iloc[0])))
        at = held["at"][ch.gathered(answers, "?")[held["index"]]]
        n = int(held["n_words"][0])
        step = np.zeros(n + 1, np.int32)
        np.add.at(step, at, 1)
        np.add.at(step, at + window, -1)
        mask = np.packbits(np.cumsum(step[:-1]) > 0).tobytes()
        path = store.write_file(place, mask)
        return pd.DataFrame({"chunk": [answers["chunk"].iloc[0]], "spans": [path]})

    masks = (
        repeated.groupBy("chunk")
        .cogroup(around.select("chunk", "file").distinct().groupBy("chunk"))
        .applyInPandas(spans, "chunk string, spans string")
    )
    return chunks, store.written(masks, "repeat-spans")


def _removed(name: str, spans: str | None) -> Iterator[tuple[int | None, list[bytes], np.ndarray]]:
    """Per document of a chunk: doc_id, its words, which of them are repeats."""
    chunk = ch.Chunk(name)
    mask = None
    if spans:
        mask = np.unpackbits(np.frombuffer(store.read_file(spans), np.uint8)).astype(bool)
    at = 0
    for key, text in zip(chunk.ids, chunk.texts):
        words = text.split()
        inside = np.zeros(len(words), bool) if mask is None else mask[at : at + len(words)]
        at += len(words)
        yield key, words, inside


def remove_repeats(
    documents: DataFrame, window: int = WINDOW, chunk_bytes: int = ch.CHUNK_BYTES
) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, spans, kept_text.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged. A word goes when a window of
    `window` words that covers it also starts anywhere else, in the same document too; windows are
    judged on the input. spans: the maximal repeats as (first word, words).
    kept_text: the other words joined by one space. A null, empty or short text
    has no windows; a row each, also for repeated rows and ids (a repeated row of enough
    words is a repeat like any other). Other columns are not read.
    """
    chunks, spans = repeats(documents, window, chunk_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out: dict[str, list] = {k: [] for k in schema.names}
                for key, words, inside in _removed(row["chunk"], row["spans"]):
                    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
                    pairs = zip(edges[0::2].tolist(), edges[1::2].tolist())
                    kept = words
                    if len(edges):
                        kept = [w for w, x in zip(words, inside.tolist()) if not x]
                    out["doc_id"].append(key)
                    out["n_words"].append(len(words))
                    out["n_removed"].append(len(words) - len(kept))
                    out["spans"].append([{"first": a, "words": b - a} for a, b in pairs])
                    out["kept_text"].append(b" ".join(kept).decode())
                whole = pa.RecordBatch.from_pydict(out, schema=schema)
                for at in range(0, len(whole), 1000):
                    yield whole.slice(at, 1000)

    span = pa.struct([("first", pa.int64()), ("words", pa.int64())])
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_removed", pa.int64()),
            ("spans", pa.list_(span)),
            ("kept_text", pa.string()),
        ]
    )
    jobs = chunks.select("chunk").join(spans, "chunk", "left").select("chunk", "spans")
    return store.dealt(jobs).mapInArrow(
        run,
        "doc_id long, n_words long, n_removed long, "
        "spans array<struct<first:long,words:long>>, kept_text string",
    )
