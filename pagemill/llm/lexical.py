"""Documents ranked for items by the terms they share: dense products of blocks of both.

(1) The distinct terms of all items are the vocabulary, in slabs of bounded size. (2) One pass
over the documents counts them: a block of documents is a file of (document, term,
occurrences) of vocabulary terms alone, and a row of sums. (3) Term weights follow from
the sums; items go into tiles, each with a compact vocabulary of its own terms.
(4) Each block of documents is multiplied with each tile of items, as dense matrices
in float64, some hundred terms at a time, so that every sum stays a whole number below 2^53; the
sums of these are added as 64-bit integers. Of a product, the best k a item are kept, equal
scores by document, and merged over the blocks.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill.llm import store

TOP = 10
SLAB_TERMS = 1 << 18  # vocabulary terms that a task holds at once
BLOCK_DOCUMENTS = 2048
BLOCK_BYTES = 8 << 20  # of text; a document is never cut
TILE_ITEMS = 256
TILE_TERMS = 1 << 16  # (item, term) pairs of a tile, unless one item has more
WIDTH = 1024  # terms multiplied at a time

_IMPACT = 1_000_000_000  # a document's impact is below a thousandth of it
_EXACT = 1 << 53
_LARGEST = np.iinfo(np.int64).max
_HELD_ROWS = 1 << 18
_SALTS = 32
# Fixed value: what separates terms are the ASCII characters that are neither digits nor letters;
# of letters only A-Z change case.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text, in order."""
    return (text or b"").translate(_TERM_BYTES).split()


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return zstandard.ZstdCompressor(level=1).compress(out.getbuffer())


def _unpacked(path: str) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(zstandard.ZstdDecompressor().decompress(store.read_file(path)))) as held:
        return dict(held)


@lru_cache(maxsize=8)
def _tile(path: str) -> dict[str, np.ndarray]:
    return _unpacked(path)


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _item_terms(items: DataFrame) -> DataFrame:
    """item, term: each item's terms once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1))):
                found = list(dict.fromkeys(terms(text)))
                yield pa.RecordBatch.from_pydict(
                    {"item": pa.array([item] * len(found), pa.int64()), "term": pa.array(found, pa.binary())}
                )

    return items.select("item", "text").mapInArrow(run, "item long, term binary")


def _vocabulary(pairs: DataFrame, place: str, slab_terms: int) -> tuple[DataFrame, list[str]]:
    """(term, term_id) and the files of the vocabulary's slabs."""
    distinct = pairs.select("term").distinct()
    numbered = store.written(
        distinct.withColumn("term_id", F.monotonically_increasing_id()), "vocabulary"
    )

    def slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flushed() -> pa.RecordBatch:
            out = io.BytesIO()
            with pa.ipc.new_stream(out, held[0].schema) as stream:
                for part in held:
                    stream.write(part)
            return pa.RecordBatch.from_pydict({"path": [store.write_file(place, out.getbuffer())]})

        for batch in batches:
            for at in range(0, len(batch), slab_terms):
                part = batch.slice(at, slab_terms)
                if sum(map(len, held)) + len(part) > slab_terms:
                    yield flushed()
                    held = []
                held.append(part)
        if held:
            yield flushed()

    files = store.written(numbered.mapInArrow(slabs, "path string"), "vocabulary-slabs")
    return numbered, sorted(r.path for r in files.collect())


@lru_cache(maxsize=2)
def _slab(path: str) -> dict[bytes, int]:
    rows = pa.ipc.open_stream(store.read_file(path)).read_all()
    return dict(zip(rows["term"].to_pylist(), rows["term_id"].to_pylist()))


def _counted(ids: list[int | None], texts: list[list[bytes]], slabs: list[str], place: str) -> dict:
    """The row of a block; its file holds what scoring needs."""
    lengths = np.array([len(words) for words in texts], np.int64)
    flat = [w for words in texts for w in words]
    found = np.full(len(flat), -1, np.int64)
    for path in slabs:
        here = np.fromiter(map(_slab(path).get, flat, repeat(-1)), np.int64, len(flat))
        found = np.maximum(found, here)
    at = np.flatnonzero(found >= 0)
    document = np.repeat(np.arange(len(texts)), lengths)[at]
    ids_of_terms, column = np.unique(found[at], return_inverse=True)
    cells, tf = np.unique(document * max(1, len(ids_of_terms)) + column, return_counts=True)
    document, column = np.divmod(cells, max(1, len(ids_of_terms)))
    # documents that share no term with any item go no further than the sums
    used, document = np.unique(document, return_inverse=True)
    data = _packed(
        null=np.array([ids[i] is None for i in used], bool),
        ids=np.array([_LARGEST if ids[i] is None else ids[i] for i in used], np.int64),
        lengths=lengths[used],
        terms=ids_of_terms,
        document=document.astype(np.int32),
        column=column.astype(np.int32),
        tf=tf,
    )
    return {
        "path": store.write_file(place, data),
        "n_documents": int((lengths > 0).sum()),
        "n_terms": int(lengths.sum()),
        "terms": ids_of_terms,
        "df": np.bincount(column, minlength=len(ids_of_terms)),
    }


def _blocks(
    documents: DataFrame, slabs: list[str], place: str, size: int, text_bytes: int
) -> DataFrame:
    """path, n_documents (with a term), n_terms; terms and df: arrays of the block's sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[list[bytes]] = []
        held = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                data = text.as_py()
                ids.append(key)
                texts.append(terms(data))
                held += len(data or b"")
                if len(ids) >= size or held >= text_bytes:
                    yield row(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield row(ids, texts)
        store.give_back()

    def row(ids: list[int | None], texts: list[list[bytes]]) -> pa.RecordBatch:
        values = _counted(ids, texts, slabs, place)
        return pa.RecordBatch.from_pydict({k: [v] for k, v in values.items()}, schema=schema)

    schema = pa.schema(
        [
            ("path", pa.string()),
            ("n_documents", pa.int64()),
            ("n_terms", pa.int64()),
            ("terms", pa.list_(pa.int64())),
            ("df", pa.list_(pa.int64())),
        ]
    )
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return store.written(
        rows.mapInArrow(
            run, "path string, n_documents long, n_terms long, terms array<long>, df array<long>"
        ),
        "document-blocks",
    )


def _weights(blocks: DataFrame, n: int) -> DataFrame:
    """term_id, weight of the terms that count for anything."""
    cells = blocks.select(F.explode(F.arrays_zip("terms", "df")).alias("c"))
    summed = cells.groupBy(F.col("c.terms").alias("term_id")).agg(F.sum("c.df").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1).cast("double")))
    return summed.select("term_id", weight.cast("long").alias("weight")).where("weight > 0")


def _tiles(weighted: DataFrame, place: str, tile_items: int, tile_terms: int) -> list[str]:
    """Files of items with their compact vocabulary: one for each `tile_items` items, or fewer."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.Series] = []
        size = 0

        def flushed() -> pd.DataFrame:
            vocabulary, column = np.unique(np.concatenate([r.terms for r in held]), return_inverse=True)
            data = _packed(
                items=np.array([r.item for r in held], np.int64),
                vocabulary=vocabulary,
                row=np.repeat(np.arange(len(held)), [len(r.terms) for r in held]).astype(np.int32),
                column=column.astype(np.int32),
                weight=np.concatenate([r.weights for r in held]).astype(np.int64),
            )
            return pd.DataFrame({"path": [store.write_file(place, data)]})

        for batch in batches:
            for r in batch.itertuples(index=False):
                if held and (len(held) == tile_items or size + len(r.terms) > tile_terms):
                    yield flushed()
                    held, size = [], 0
                held.append(r)
                size += len(r.terms)
        if held:
            yield flushed()

    by_item = store.written(
        weighted.groupBy("item")
        .agg(F.collect_list(F.struct("term_id", "weight")).alias("c"))
        .select("item", F.col("c.term_id").alias("terms"), F.col("c.weight").alias("weights")),
        "item-terms",
    )
    tasks = max(1, -(-by_item.count() // tile_items))
    files = store.written(by_item.repartition(tasks).mapInPandas(run, "path string"), "item-tiles")
    return sorted(r.path for r in files.collect())


def _scores(tile: dict[str, np.ndarray], block: dict[str, np.ndarray], impact: np.ndarray) -> np.ndarray:
    """Items by documents: whole-number scores."""
    vocabulary = tile["vocabulary"]
    n_items, n_documents = len(tile["items"]), len(block["ids"])
    total = np.zeros((n_items, n_documents), np.int64)
    # columns: the terms that both have, numbered compactly
    common, of_tile, of_block = np.intersect1d(
        vocabulary, block["terms"], assume_unique=True, return_indices=True
    )
    tile_column = np.full(len(vocabulary), -1, np.int64)
    tile_column[of_tile] = np.arange(len(common))
    block_column = np.full(len(block["terms"]), -1, np.int64)
    block_column[of_block] = np.arange(len(common))
    a, b = tile_column[tile["column"]], block_column[block["column"]]
    most = int(tile["weight"].max(initial=1)) * (_IMPACT // 1000)
    width = min(WIDTH, (_EXACT - 1) // most)
    if width < 1:
        raise OverflowError("a single term's score is above 2^53")
    for first in range(0, len(common), width):
        left = np.zeros((n_items, width))
        mine = (a >= first) & (a < first + width)
        left[tile["row"][mine], a[mine] - first] = tile["weight"][mine]
        right = np.zeros((width, n_documents))
        mine = (b >= first) & (b < first + width)
        right[b[mine] - first, block["document"][mine]] = impact[mine]
        total += (left @ right).astype(np.int64)
    return total


def _impacts(block: dict[str, np.ndarray], n: int, length: int) -> np.ndarray:
    """Impact of each (document, term) of a block."""
    if 90 * n * int(block["lengths"].max(initial=0)) > _LARGEST:
        raise OverflowError("90 * terms of a document * documents is above 64 bits")
    m = 10 + 90 * block["lengths"] * n // max(1, length)
    return (_IMPACT * block["tf"]) // (1000 * block["tf"] + 8 * m[block["document"]])


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's k largest positive scores; of equal ones the first columns."""
    least = np.zeros(len(scores), np.int64)
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    least = np.maximum(least, 1)[:, None]
    over, equal = scores > least, scores == least
    room = k - over.sum(axis=1, keepdims=True)
    return np.nonzero(over | (equal & (np.cumsum(equal, axis=1) <= room)))


class _Ranking:
    """The best k documents an item so far: larger score, then smaller id, null ids last."""

    def __init__(self, k: int):
        self._k = k
        self._parts: list[np.ndarray] = []
        self._held = 0

    def add(self, items: np.ndarray, scores: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        self._parts.append(np.column_stack([items, scores, null, ids]))
        self._held += len(items)
        if self._held > _HELD_ROWS:
            self._shrink()

    def full(self) -> bool:
        """So many items that even their best documents should be handed on."""
        return self._held > _HELD_ROWS // 2

    def _shrink(self) -> None:
        rows = np.concatenate(self._parts)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
        first = np.searchsorted(rows[:, 0], rows[:, 0])
        rows = rows[np.arange(len(rows)) - first < self._k]
        self._parts, self._held = [rows], len(rows)

    def rows(self) -> pa.RecordBatch:
        self._parts.append(np.zeros((0, 4), np.int64))
        self._shrink()
        rows = self._parts[0]
        self._parts, self._held = [], 0
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows[:, 0]),
                pa.array(rows[:, 1]),
                pa.array(rows[:, 3], mask=rows[:, 2] > 0),
            ],
            names=["item", "score", "doc_id"],
        )


def rank_documents(
    documents: DataFrame,
    items: DataFrame,
    k: int = TOP,
    slab_terms: int = SLAB_TERMS,
    block_documents: int = BLOCK_DOCUMENTS,
    tile_items: int = TILE_ITEMS,
    tile_terms: int = TILE_TERMS,
) -> DataFrame:
    """Per item its k best documents: item_id, rank, doc_id, score.

    Terms are the longest matches of `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`, A-Z in lower case.
    With N documents that have a term, L terms in all, n in a document, df documents with a
    term, tf times in the document: a term weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's
    m = 10 + 90 n N div L, and its score is the sum of w * (10^9 tf div (1000 tf + 8 m)) over the item's
    distinct terms. Scores above 0 count; equal ones go by doc_id, null ids last. A null or
    empty text has no terms. Every row is a document or an item of its own, repeated rows
    and ids too; an item that shares no term of any weight with a document has no rows. A
    document is never cut. Other columns are not read.
    """
    spark: SparkSession = documents.sparkSession
    place = store.folder(spark, "lexical")
    numbered = store.written(
        items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).withColumn(
            "item", F.monotonically_increasing_id()
        ),
        "items",
    )
    pairs = store.written(_item_terms(numbered), "item-words")
    vocabulary, slabs = _vocabulary(pairs, place, slab_terms)
    blocks = _blocks(documents, slabs, place, block_documents, BLOCK_BYTES)
    n, length = blocks.agg(
        F.coalesce(F.sum("n_documents"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))
    ).first()
    weighted = (
        pairs.join(vocabulary, "term").join(_weights(blocks, n), "term_id").select("item", "term_id", "weight")
    )
    tiles = _tiles(weighted, place, tile_items, tile_terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking = _Ranking(k)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                block = _unpacked(path)
                order = np.lexsort((block["ids"], block["null"]))  # equal scores by document
                block["document"] = np.argsort(order)[block["document"]]
                for name in ("ids", "null", "lengths"):
                    block[name] = block[name][order]
                impact = _impacts(block, n, length)
                for at in tiles:
                    tile = _tile(at)
                    scores = _scores(tile, block, impact)
                    row, column = _best(scores, k)
                    ranking.add(
                        tile["items"][row], scores[row, column], block["null"][column], block["ids"][column]
                    )
                    if ranking.full():
                        yield ranking.rows()
        yield ranking.rows()
        store.give_back()

    found = store.dealt(blocks.select("path")).mapInArrow(run, "item long, score long, doc_id long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # first within groups of tasks, then over all of them: no task meets every task's rows of an item
    part = Window.partitionBy("item", "part").orderBy(*order)
    over = Window.partitionBy("item").orderBy(*order)
    return (
        found.withColumn("part", F.spark_partition_id() % _SALTS)
        .withColumn("rank", F.row_number().over(part))
        .where(F.col("rank") <= k)
        .withColumn("rank", F.row_number().over(over))
        .where(F.col("rank") <= k)
        .join(numbered.select("item", "item_id"), "item")
        .select("item_id", "rank", "doc_id", "score")
    )
