"""Runs of repeated word sequences inside documents ("a b c a b c a b c ..."), and their collapse."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.llm import store
from pagemill.llm.squares import SquareCatcher

EXPONENT = 4  # periods that a run has at least
LEAST = 6  # words that a run has at least
GROUP_WORDS = 1 << 19  # short documents are searched together up to this many words

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("runs", pa.list_(_RUN)),
        ("collapsed_text", pa.string()),
    ]
)
_DDL = (
    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
    "collapsed_text string"
)


def runs_of(texts: list[list[bytes]], exponent: int, least: int) -> list[list[tuple[int, int, int]]]:
    """Per text (a list of words), its runs (start, length, period) by start, then period.

    The texts are one sequence for the catcher, with a number that comes once behind
    each: nothing with two periods holds such a number.
    """
    numbers: dict[bytes, int] = {}
    for words in texts:
        for w in words:
            numbers.setdefault(w, len(numbers))
    longest = max(map(len, texts), default=0)
    catcher = SquareCatcher(exponent, least, longest // exponent)
    lengths = np.array([len(words) + 1 for words in texts])
    ends = np.cumsum(lengths)
    begins = ends - lengths
    sequence = np.empty(ends[-1] if len(ends) else 0, np.int64)
    for i, (words, a, b) in enumerate(zip(texts, begins.tolist(), ends.tolist())):
        sequence[a : b - 1] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        sequence[b - 1] = len(numbers) + i
    catcher.append(sequence)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in catcher.runs():
        i = int(np.searchsorted(begins, start, "right")) - 1
        out[i].append((start - int(begins[i]), length, period))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    if not runs:
        return b" ".join(words).decode()
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    inside = np.cumsum(step[:-1]) > 0
    return b" ".join(w for w, x in zip(words, inside.tolist()) if not x).decode()


def periodic_runs(
    documents: DataFrame, exponent: int = EXPONENT, least: int = LEAST, group_words: int = GROUP_WORDS
) -> DataFrame:
    """Per document: doc_id, n_words, runs, collapsed_text.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0. A run is a stretch of words
    with smallest period q and at least max(least, exponent * q) words that no word next to it
    continues. runs: (start, length, period) by start, then period. collapsed_text: the
    words that no run has after its first q words, joined by one space. A null,
    empty or short text has no runs; a row each, also for repeated rows and ids and null ids.
    A document is one task's work whatever its length: it needs about 100 bytes a
    word. Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[int | None] = []
        texts: list[list[bytes]] = []
        held = 0

        def searched() -> pa.RecordBatch:
            found = runs_of(texts, exponent, least)
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": keys,
                    "n_words": [len(words) for words in texts],
                    "runs": [
                        [{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found
                    ],
                    "collapsed_text": [_collapsed(w, r) for w, r in zip(texts, found)],
                },
                schema=_SCHEMA,
            )

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                words = (text.as_py() or b"").split()
                keys.append(key.as_py())
                texts.append(words)
                held += len(words) + 1
                if held >= group_words:
                    yield searched()
                    keys, texts, held = [], [], 0
        if keys:
            yield searched()
        store.give_back()

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, _DDL)
