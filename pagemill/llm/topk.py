"""What the vector searches share: valid vectors, blocks, running best lists, their merge."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm import store

_STATE_QUERIES = 50_000  # queries whose best lists a task holds at once

FOUND = "query_id long, ids binary, scores binary"  # a list a query, best first


def valid_vectors(vectors: DataFrame, *, value: Callable[[Column], Column], zero: bool) -> DataFrame:
    """vec_id and v (array<double>) of rows that take part; equal rows count once.

    Left out: null ids, null or empty vectors, vectors with null or non-finite
    components and, unless `zero`, zero vectors. Other columns are not read.
    """
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    if not zero:
        fine = fine & F.exists(x, lambda c: c != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size(x) > 0) & fine)
    return rows.select(
        F.col("vec_id").cast("long"), F.transform(x, lambda c: value(c.cast("double"))).alias("v")
    ).distinct()


def matrix(column: pd.Series, dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones are continued with zeros."""
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def measures(vectors: DataFrame) -> tuple[int, int, float]:
    """Number of vectors, longest length, largest squared norm."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    row = vectors.agg(F.count("*"), F.max(F.size("v")), F.max(square)).first()
    return row[0], row[1] or 1, float(row[2] or 0.0)


def sample(vectors: DataFrame, size: int, dim: int) -> np.ndarray:
    """At most `size` vectors, the same each time: those with the smallest hashes.

    Each task of a sort with a limit hands on `size` rows. So only hashes up to a bound that
    hardly more than `size` rows reach are sorted, and the tasks' rows never meet on the driver.
    """
    hashes = vectors.select(F.xxhash64("vec_id").alias("h"), "vec_id", "v")
    bounds = [-(1 << 63) + (1 << i) for i in range(63, 0, -1)]
    counts = hashes.agg(*(F.count_if(F.col("h") < b) for b in bounds)).first()
    enough = [b for b, c in zip(bounds, counts) if c >= size]
    if enough:
        hashes = hashes.where(F.col("h") < enough[-1])
    rows = kept(hashes.orderBy("h", "vec_id", "v").limit(size), "sample").toPandas()
    return matrix(rows.sort_values(["h", "vec_id"], kind="stable")["v"], dim)


def lifted(x: np.ndarray, square: float) -> np.ndarray:
    """One more component, so that all rows have the squared norm `square`: among such rows the
    nearest to a query (lifted by 0) is the one with the largest inner product."""
    rest = np.sqrt(np.maximum(square - np.einsum("ij,ij->i", x, x), 0))
    return np.column_stack([x, rest])


def blocks(
    rows: DataFrame, order: list[str], size: int, total: int, within: list[str], schema: str,
    tasks: int | None = None,
) -> DataFrame:
    """Rows in the given order, packed into rows of at most `size` of them.

    rows: `order` columns among them, vec_id, and binary x. A block never spans
    different values of `within`; however many rows share such a value, they
    are dealt over tasks by the rest of the order. Adds block, ids and xs.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    others = [c for c in names if c not in ("block", "ids", "xs", *within)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        held: list[pd.DataFrame] = []

        def packed(frames: list[pd.DataFrame]) -> dict:
            nonlocal number
            f = pd.concat(frames)
            number += 1
            out = {"block": number - 1, "ids": f["vec_id"].to_numpy("<i8").tobytes()}
            out["xs"] = b"".join(f["x"])
            out |= {k: f[k].iloc[0] for k in within}
            return out | {k: np.ascontiguousarray(f[k]).tobytes() for k in others}

        for batch in batches:
            out = []
            groups = batch.groupby(within, sort=False) if within else [((), batch)]
            for key, part in groups:
                if held and within and tuple(held[0][within].iloc[0]) != tuple(part[within].iloc[0]):
                    out.append(packed(held))
                    held = []
                while len(part):
                    room = size - sum(map(len, held))
                    held.append(part.iloc[:room])
                    part = part.iloc[room:]
                    if sum(map(len, held)) == size:
                        out.append(packed(held))
                        held = []
            if out:
                yield pd.DataFrame(out, columns=names)
        if held:
            yield pd.DataFrame([packed(held)], columns=names)

    tasks = max(1, -(-total // size) if tasks is None else tasks)
    return rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInPandas(
        run, schema
    )


class Best:
    """The best `k` per query so far: larger score first, then smaller id."""

    def __init__(self, k: int):
        self.k = k
        self._clear()

    def _clear(self) -> None:
        self._slot: dict[int, int] = {}
        self._ids = np.zeros((0, self.k), np.int64)
        self._scores = np.zeros((0, self.k))

    def slots(self, queries: np.ndarray) -> np.ndarray:
        for q in queries.tolist():
            self._slot.setdefault(q, len(self._slot))
        grown = len(self._slot) - len(self._ids)
        if grown > 0:
            more = max(grown, len(self._ids))
            self._ids = np.vstack([self._ids, np.full((more, self.k), -1, np.int64)])
            self._scores = np.vstack([self._scores, np.full((more, self.k), -np.inf)])
        return np.array([self._slot[q] for q in queries.tolist()], np.int64)

    def least(self, slots: np.ndarray) -> np.ndarray:
        """What a score must reach to matter."""
        return self._scores[slots, -1]

    def add(self, slot: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """One entry per candidate; a candidate may come again, and keeps its best score."""
        if not len(slot):
            return
        touched = np.unique(slot)
        old_slot = np.repeat(touched, self.k)
        old_ids, old_scores = self._ids[touched].ravel(), self._scores[touched].ravel()
        real = old_scores > -np.inf
        s = np.concatenate([slot, old_slot[real]])
        i = np.concatenate([ids, old_ids[real]])
        v = np.concatenate([scores, old_scores[real]])
        order = np.lexsort((-v, i, s))
        s, i, v = s[order], i[order], v[order]
        new = np.concatenate([[True], (s[1:] != s[:-1]) | (i[1:] != i[:-1])])
        s, i, v = s[new], i[new], v[new]
        order = np.lexsort((i, -v, s))
        s, i, v = s[order], i[order], v[order]
        first = np.searchsorted(s, touched)
        rank = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
        keep = rank < self.k
        self._ids[touched], self._scores[touched] = -1, -np.inf
        self._ids[s[keep], rank[keep]] = i[keep]
        self._scores[s[keep], rank[keep]] = v[keep]

    def lists(self) -> pd.DataFrame:
        """All that is held, a row a query; the lists are empty then."""
        n = len(self._slot)
        counts = (self._scores[:n] > -np.inf).sum(axis=1)
        out = pd.DataFrame(
            {
                "query_id": np.fromiter(self._slot, np.int64, n),
                "ids": [v[:c].tobytes() for v, c in zip(self._ids, counts)],
                "scores": [v[:c].tobytes() for v, c in zip(self._scores, counts)],
            }
        )[counts > 0]
        self._clear()
        return out

    def add_lists(self, lists: pd.DataFrame) -> None:
        ids = [np.frombuffer(v, "<i8") for v in lists["ids"]]
        slots = np.repeat(self.slots(lists["query_id"].to_numpy()), [len(v) for v in ids])
        if ids:
            scores = np.concatenate([np.frombuffer(v, "<f8") for v in lists["scores"]])
            self.add(slots, np.concatenate(ids), scores)

    def full(self) -> bool:
        return len(self._slot) > _STATE_QUERIES


def best_pairs(scores: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that may be among a row's best k: all that reach both `least` and the
    row's k-th score, ties included."""
    if scores.shape[1] > k:
        kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        least = np.maximum(least, kth)
    return np.nonzero(scores >= least[:, None])


def merged(found: DataFrame, k: int) -> DataFrame:
    """A list a query, the best k of all its lists."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best, held = Best(k), None  # held: lists of the last query so far
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch])
            last = rows["query_id"] == rows["query_id"].iloc[-1]
            best.add_lists(rows[~last])
            yield best.lists()
            best.add_lists(rows[last])
            held = best.lists()
        if held is not None:
            yield held

    by_query = found.repartition("query_id").sortWithinPartitions("query_id")
    return by_query.mapInPandas(run, FOUND)


def ranked(lists: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score of every entry."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [np.frombuffer(v, "<i8") for v in batch["ids"]]
            none = np.zeros(0)
            yield pd.DataFrame(
                {
                    "query_id": np.repeat(batch["query_id"].to_numpy(), [len(v) for v in ids]),
                    "rank": np.concatenate([none, *(np.arange(1, len(v) + 1) for v in ids)]).astype("i4"),
                    "vec_id": np.concatenate([none.astype("<i8"), *ids]),
                    "score": np.concatenate([none, *(np.frombuffer(v, "<f8") for v in batch["scores"])]),
                }
            )

    return lists.mapInPandas(run, "query_id long, rank int, vec_id long, score double")


def kept(frame: DataFrame, purpose: str) -> DataFrame:
    return store.written(frame, purpose)
