"""Packing documents into training sequences, balanced by their cost.

A piece of n tokens costs LINEAR * n + QUADRATIC * n * n: the work of the layers
that see one token at a time, and of attention within the piece. Documents are
cut into pieces of at most one sequence; then pieces go in descending order to
the lowest-cost sequence with room for them. What fits nowhere whole fills the
lowest-cost sequences that have room left, so no token is padding: a group of
documents makes as many full sequences as its tokens allow, and the rest goes
into sequences whose lengths are powers of two.

Each piece carries its token ids, so the pieces of a sequence, in the order of
their offsets, are that sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm import store
from pagemill.llm.tokens import encoded_rows, vocabulary_path

SEQUENCE_TOKENS = 4096
LINEAR = 1.0  # cost of a token outside attention
QUADRATIC = 1.0 / SEQUENCE_TOKENS  # cost of a pair of tokens of one piece
GROUP_TOKENS = 1 << 20  # tokens packed together: 256 full sequences

SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "piece_cost double, ids binary"
)


def piece_cost(length: int) -> float:
    return LINEAR * length + QUADRATIC * length * length


def capacities(total: int, size: int) -> list[int]:
    """Full sequences, then the powers of two that add up to what is left."""
    full, rest = divmod(total, size)
    powers = [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1]
    return [size] * full + powers


def assign(lengths: list[int], size: int = SEQUENCE_TOKENS) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece of one group.

    Ties go to the document, and to the sequence, that comes first.
    """
    pieces = [
        (min(size, n - at), document, at)
        for document, n in enumerate(lengths)
        for at in range(0, n, size)
    ]
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
    capacity = np.array(capacities(sum(lengths), size), np.int64)
    free, cost, out = capacity.copy(), np.zeros(len(capacity)), []
    for length, document, at in pieces:
        while length:
            fits = free >= length
            open_ = fits if fits.any() else free > 0
            best = int(np.argmin(np.where(open_, cost, np.inf)))
            part = int(min(length, free[best]))
            out.append((document, at, part, best, int(capacity[best] - free[best])))
            free[best] -= part
            cost[best] += piece_cost(part)
            at += part
            length -= part
    return out


def pack(
    documents: DataFrame,
    vocabulary: str | None = None,
    size: int = SEQUENCE_TOKENS,
    group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    piece_cost, ids.

    `ids` are the token ids of the piece, as little-endian unsigned 32-bit integers;
    `ids_crc32` is the CRC-32 of that column.

    Documents are packed with those beside them in the scan, in groups of about
    `group_tokens`, so nothing is shuffled and a task holds one group, whatever
    the size of the input or of one source. Reading `documents` must give the
    same partitions and order on a retry, as a scan of files does; sequence ids
    are the number of the partition times 2^33 plus a count.

    A null or empty text is its end id alone. Repeated rows and ids are packed
    each on its own. A null doc_id stays null. Other columns are not read.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store.give_back()  # what an earlier stage left in this worker
        next_id = TaskContext.get().partitionId() << 33
        keys, ids, held = [], [], 0
        for key, doc in encoded_rows(batches, path):
            keys.append(key)
            ids.append(doc)
            held += len(doc)
            if held >= group_tokens:
                rows, used = _packed(keys, ids, size, next_id)
                keys, ids, held = [], [], 0
                yield rows
                del rows
                next_id += used
                store.give_back()
        if keys:
            yield _packed(keys, ids, size, next_id)[0]
        del keys, ids
        store.give_back()

    return (
        documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .mapInArrow(run, SCHEMA)
        .select(
            "doc_id",
            "start",
            "length",
            F.crc32("ids").alias("ids_crc32"),
            "doc_tokens",
            "sequence_id",
            "offset",
            "piece_cost",
            "ids",
        )
    )


def _packed(
    keys: list[int | None], ids: list[np.ndarray], size: int, first: int
) -> tuple[pa.RecordBatch, int]:
    pieces = assign([len(x) for x in ids], size)
    documents, starts, lengths, sequences, offsets = (np.array(x) for x in zip(*pieces))
    # bytes: pyarrow never lets go of memoryviews, so the worker would keep all ids it ever packed
    data = [ids[d][a : a + n].astype("<u4").tobytes() for d, a, n, _, _ in pieces]
    columns = [
        pa.array([keys[d] for d in documents], pa.int64()),
        starts,
        lengths,
        np.array([len(x) for x in ids])[documents],
        first + sequences,
        offsets,
        np.array([piece_cost(n) for n in lengths.tolist()]),
        pa.array(data, pa.binary()),
    ]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names), 1 + int(sequences.max())
