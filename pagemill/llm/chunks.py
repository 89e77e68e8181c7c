"""Documents in chunk files, and the exchange of hashes between chunks.

Several operators ask, of every shingle or window of every document, where else
it occurs. As rows, that is one a word. Here a chunk (some megabytes of whole
documents, one file in the shared folder) sends each of its distinct hashes
once, as sorted arrays cut by the leading bits; what gathers in a bucket is
at most one entry a chunk for any hash, however frequent it is. The answer goes
back as an array in the same order, so no positions travel. Chunks are
re-read by name: what a lost executor computed is computed again from the same
file, with the same result.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm import store

CHUNK_BYTES = 4 << 20  # of text: a task needs about twenty times as much memory
BUCKET_ENTRIES = 1 << 20  # about the hashes in one bucket

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SLAB = 1 << 20

# odd multipliers and random words, from fixed seeds: every task has the same
_BYTE_WORDS = np.random.default_rng(20_240_101).integers(0, 1 << 64, (2, 256), np.uint64)
_BYTE_STEP = [0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93]
_WORD_STEP = [0xC2B2AE3D27D4EB4F, 0x2545F4914F6CDD1D]


def write_chunks(
    documents: DataFrame, place: str, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Write doc_id and text to chunk files; one row a chunk: chunk, n_bytes, n_documents.

    A document is never cut. Null texts stay null, null ids stay null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pagemill.llm.tokens import encoder  # which needs this module

        held, size = [], 0
        encoder.cache_clear()  # what an earlier stage left in this worker
        store.give_back()

        def flushed() -> pa.RecordBatch:
            rows, out = pa.Table.from_batches(held), io.BytesIO()
            pq.write_table(rows, out, compression="zstd", use_dictionary=False)
            name = store.write_file(place, out.getvalue())
            return pa.RecordBatch.from_pydict(
                {"chunk": [name], "n_bytes": [size], "n_documents": [len(rows)]}
            )

        for batch in batches:
            step = max(1, int(len(batch) * chunk_bytes / max(1, batch.nbytes)))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                held.append(part)
                size += part.get_total_buffer_size() if len(batch) <= step else part.nbytes
                if size >= chunk_bytes:
                    yield flushed()
                    held, size = [], 0
                    store.give_back()
        if held:
            yield flushed()
        held = []
        store.give_back()

    return store.written(
        documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            run, "chunk string, n_bytes long, n_documents long"
        ),
        "chunks",
    )


class Chunk:
    """The documents of one chunk file."""

    def __init__(self, name: str):
        rows = pq.read_table(io.BytesIO(store.read_file(name)))
        self.ids: list[int | None] = rows["doc_id"].to_pylist()
        texts = rows["text"].combine_chunks()
        self.texts: list[bytes] = [x or b"" for x in texts.cast(pa.binary()).to_pylist()]

    def word_hashes(self, copies: int = 1) -> tuple[list[np.ndarray], np.ndarray]:
        """Hashes of all words of all documents (`copies` independent ones), and where each
        document's words begin (one entry more than documents)."""
        parts: list[list[np.ndarray]] = [[] for _ in range(copies)]
        counts, slab, size = [], [], 0
        for i, text in enumerate(self.texts):
            slab.append(text)
            size += len(text) + 1
            if size >= _SLAB or i == len(self.texts) - 1:
                hashes, words = _words_of(slab, copies)
                for part, h in zip(parts, hashes):
                    part.append(h)
                counts.append(words)
                slab, size = [], 0
        none = np.zeros(0, np.uint64)
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(counts) if counts else none)])
        return [np.concatenate(p) if p else none for p in parts], bounds.astype(np.int64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the argument."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _powers(step: int, n: int) -> np.ndarray:
    powers = np.full(n, step, np.uint64)
    if n:
        powers[0] = 1
    return np.multiply.accumulate(powers)


def _inverse(step: int) -> int:
    return pow(step, -1, 1 << 64)


def _words_of(texts: list[bytes], copies: int) -> tuple[list[np.ndarray], np.ndarray]:
    joined = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = _SPACE[joined]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    if len(ends) < len(starts):
        ends = np.append(ends, len(joined))
    lengths = np.array([len(t) + 1 for t in texts])
    words = np.bincount(
        np.searchsorted(np.cumsum(lengths), starts, "right"), minlength=len(texts)
    )[: len(texts)]
    return [_span_hashes(joined, starts, ends, c) for c in range(copies)], words


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, copy: int) -> np.ndarray:
    powers = _powers(_BYTE_STEP[copy], len(data))
    total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE_WORDS[copy][data] * powers)])
    back = _powers(_inverse(_BYTE_STEP[copy]), len(data) + 1)
    lengths = (ends - starts).astype(np.uint64)
    return mixed((total[ends] - total[starts]) * back[starts] + lengths)


def windows(words: np.ndarray, bounds: np.ndarray, length: int, copy: int = 0) -> np.ndarray:
    """Hash of the `length` words from each word on; zero where a document has fewer left."""
    n = len(words)
    out = np.zeros(n, np.uint64)
    if n < length:
        return out
    total = np.concatenate(
        [[np.uint64(0)], np.cumsum(words * _powers(_WORD_STEP[copy], n))]
    )
    back = _powers(_inverse(_WORD_STEP[copy]), n)
    out[: n - length + 1] = mixed((total[length:] - total[:-length]) * back[: n - length + 1])
    out |= out == 0  # zero is kept for "no window"
    out[~starts_window(bounds, length)] = 0
    return out


def starts_window(bounds: np.ndarray, length: int) -> np.ndarray:
    """Whether each word has `length` words of its document from it on."""
    counts = np.diff(bounds)
    left = np.repeat(bounds[1:], counts) - np.arange(bounds[-1])
    return left >= length


def buckets_for(chunks: DataFrame, bytes_per_entry: int = 6) -> int:
    """A power of two that follows the volume of all texts."""
    volume = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    wanted = max(64, volume // bytes_per_entry // BUCKET_ENTRIES)
    return 1 << int(wanted - 1).bit_length()


def slices(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins in sorted hashes (one entry more than buckets)."""
    bits = buckets.bit_length() - 1
    edges = np.arange(1, buckets, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])


def sent(
    name: str, hashes: np.ndarray, buckets: int, width: int, **more: np.ndarray
) -> pd.DataFrame:
    """A chunk's distinct sorted hashes as a row a bucket.

    `width` bytes of a hash go along besides the bucket's own bits (4 or 8);
    `more` are arrays in the same order.
    """
    bits = np.uint64(buckets.bit_length() - 1)
    short = (hashes << bits) >> np.uint64(64 - 8 * width) if width < 8 else hashes
    short = short.astype(f"<u{width}")
    at = slices(hashes, buckets)
    full = np.flatnonzero(np.diff(at))
    cut = {"hashes": short, **more}
    return pd.DataFrame(
        {
            "bucket": full,
            "chunk": name,
            **{k: [v[at[b] : at[b + 1]].tobytes() for b in full] for k, v in cut.items()},
        }
    )


def answered(
    rows: DataFrame,
    width: int,
    kinds: dict[str, str],
    answer: Callable[..., np.ndarray],
) -> DataFrame:
    """Per chunk and bucket, an array in the order of the hashes that were sent.

    `answer(group, **arrays)` gets, for all entries of a bucket, the number of
    the entry's hash among the distinct ones, and what was sent along
    (`kinds`: their types); it returns an entry each. Rows: chunk, bucket, answer.
    """

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("chunk")
        parts = [np.frombuffer(x, f"<u{width}") for x in batch["hashes"]]
        _, group = np.unique(np.concatenate(parts), return_inverse=True)
        arrays = {
            k: np.concatenate([np.frombuffer(x, kind) for x in batch[k]])
            for k, kind in kinds.items()
        }
        result = answer(group, **arrays)
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        out = batch[["chunk", "bucket"]].copy()
        out["answer"] = [x.tobytes() for x in np.split(result, cuts)]
        del parts, group, arrays, result
        store.give_back()
        return out

    return rows.groupBy("bucket").applyInPandas(run, "chunk string, bucket long, answer binary")


def gathered(rows: pd.DataFrame, kind: str) -> np.ndarray:
    """The answers of one chunk in the order of its hashes."""
    parts = [np.frombuffer(x, kind) for x in rows.sort_values("bucket")["answer"]]
    return np.concatenate(parts) if parts else np.zeros(0, kind)
