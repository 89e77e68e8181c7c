"""Exact top-k by inner product over a pivot-distance index.

Vectors are lifted by one component to a common norm, where the largest inner
product is the smallest distance. Each is keyed by its nearest pivot and the distance to it,
and the index is all vectors in the order of that key, in blocks. For a
query at distance D from a pivot and within t of its k-th best so far, a vector
at distance d from the pivot matters only if |D - d| <= t (triangle inequality).
Queries go in blocks of near ones: first to the block around their own key, for
a first t, then to the blocks whose annuli reach within it; inside a block the
annuli nearest to the queries' come first, and t shrinks as they are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.llm import topk

PIVOTS = 64  # so the pivots that go to every task are 64 vectors
PIVOT_SAMPLE = 2048  # vectors among which pivots are chosen
BLOCK_ROWS = 8192
QUERY_ROWS = 512
ANNULUS_ROWS = 1024


def _pivots(vectors: DataFrame, dim: int, square: float) -> np.ndarray:
    """Far apart from each other, among a bounded sample."""
    x = topk.lifted(topk.sample(vectors, PIVOT_SAMPLE, dim), square)
    if not len(x):
        return np.zeros((1, dim + 1))
    chosen = [0]
    gap = np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < min(PIVOTS, len(x)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


class _Search:
    """Scores of a query block against index blocks, with the bounds of the docstring above."""

    def __init__(self, dim: int, square: float, kind: str, pivots: int, k: int):
        self.dim, self.square, self.kind, self.pivots, self.k = dim, square, kind, pivots, k
        # rounding of distances and norms, far below what one unit of a score makes
        self.slack = 1e-6 * max(1.0, np.sqrt(square))

    def values(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, self.kind).reshape(-1, self.dim).astype(np.float64)

    def reach(self, squares: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Distance within which a vector must lie to have the score `least`."""
        return np.sqrt(np.maximum(squares + self.square - 2 * least, 0)) + self.slack

    def block(self, row, best: topk.Best) -> None:
        """row: ids, xs, cells, dists of an index block; q_ids, q_xs, q_dists of queries."""
        q, q_ids = self.values(row.q_xs), np.frombuffer(row.q_ids, "<i8")
        x, ids = self.values(row.xs), np.frombuffer(row.ids, "<i8")
        cells, dists = np.frombuffer(row.cells, "<i4"), np.frombuffer(row.dists, "<f8")
        away = np.frombuffer(row.q_dists, "<f8").reshape(len(q), self.pivots)
        squares = (q * q).sum(axis=1)
        slots = best.slots(q_ids)
        floor = np.frombuffer(row.floors, "<f8") if row.floors is not None else None
        edge = np.flatnonzero(np.diff(cells, prepend=-1))
        annuli = [
            (a, min(a + ANNULUS_ROWS, end))
            for start, end in zip(edge, np.append(edge[1:], len(cells)))
            for a in range(start, end, ANNULUS_ROWS)
        ]
        gaps = []
        for a, b in annuli:
            d = away[:, cells[a]]
            gaps.append(np.maximum(np.maximum(d - dists[b - 1], dists[a] - d), 0))
        for i in np.argsort([g.mean() for g in gaps], kind="stable"):
            a, b = annuli[i]
            least = best.least(slots)
            if floor is not None:
                least = np.maximum(least, floor)
            near = np.flatnonzero(gaps[i] <= self.reach(squares, least))
            if not len(near):
                continue
            scores = q[near] @ x[a:b].T
            scores[q_ids[near][:, None] == ids[a:b]] = -np.inf
            at, column = topk.best_pairs(scores, np.maximum(least[near], -1.7e308), self.k)
            best.add(slots[near][at], ids[a:b][column], scores[at, column])


def pivot_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    scale: int = 64,
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k largest inner products.

    Components are floor(scale * x); scores are exact while they stay below
    2^53. Ties go to the smaller vec_id. Rows that share the query's vec_id are its
    own; vectors that share an id count as one with their best score. Shorter vectors are continued
    with zeros. See topk.valid_vectors for rows that take no part; an empty table gives no rows.
    """
    rows = topk.kept(
        topk.valid_vectors(
            vectors, value=lambda c: F.floor(c * scale).cast("double"), zero=True
        ).withColumn("is_query", is_query),
        "vectors",
    )
    n, dim, square = topk.measures(rows)
    largest = rows.agg(F.max(F.array_max(F.transform("v", lambda c: F.abs(c))))).first()[0] or 0
    kind = "<i1" if largest <= 127 else "<i2" if largest <= 32767 else "<f8"
    pivots = _pivots(rows, dim, square)
    search = _Search(dim, square, kind, len(pivots), k)

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = topk.matrix(batch["v"], dim)
            away = _distances(topk.lifted(x, square), pivots)
            cell = away.argmin(axis=1)
            yield pd.DataFrame(
                {
                    "vec_id": batch["vec_id"],
                    "cells": cell.astype(np.int32),
                    "dists": away[np.arange(len(x)), cell],
                    "x": [v.astype(kind).tobytes() for v in x],
                    "is_query": batch["is_query"],
                }
            )

    keys = topk.kept(
        rows.mapInPandas(
            keyed, "vec_id long, cells int, dists double, x binary, is_query boolean"
        ),
        "pivot-keys",
    )
    order = ["cells", "dists", "vec_id"]
    index = topk.kept(
        topk.blocks(
            keys.drop("is_query"), order, BLOCK_ROWS, n, [],
            "block long, ids binary, xs binary, cells binary, dists binary",
        ),
        "pivot-index",
    )
    asked = keys.where("is_query").drop("is_query")
    n_asked = asked.count()

    def with_distances(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for x in batch["xs"]:
                q = np.column_stack([v := search.values(x), np.zeros(len(v))])
                out.append(_distances(q, pivots).tobytes())
            yield batch.assign(q_dists=out)

    queries = topk.kept(
        topk.blocks(
            asked, order, QUERY_ROWS, n_asked, [],
            "block long, ids binary, xs binary, cells binary, dists binary",
        )
        .mapInPandas(
            with_distances,
            "block long, ids binary, xs binary, cells binary, dists binary, q_dists binary",
        )
        .selectExpr(
            "block AS q_block", "ids AS q_ids", "xs AS q_xs", "cells AS q_cells",
            "dists AS q_own", "q_dists",
        ),
        "query-blocks",
    )

    def ranges(number: str, cells: str, dists: str, lo: str, hi: str):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                parts = []
                for b, c, d in zip(batch[number], batch[cells], batch[dists]):
                    f = pd.DataFrame(
                        {"cell": np.frombuffer(c, "<i4"), "d": np.frombuffer(d, "<f8")}
                    )
                    f = f.groupby("cell")["d"].agg(["min", "max"]).reset_index()
                    parts.append(f.assign(number=b)[["number", "cell", "min", "max"]])
                out = pd.concat(parts)
                out.columns = [number, "cell", lo, hi]
                yield out

        return run

    directory = topk.kept(
        index.select("block", "cells", "dists").mapInPandas(
            ranges("block", "cells", "dists", "lo", "hi"), "block long, cell int, lo double, hi double"
        ),
        "pivot-directory",
    )
    wanted = queries.select("q_block", "q_cells", "q_own").mapInPandas(
        ranges("q_block", "q_cells", "q_own", "q_lo", "q_hi"), "q_block long, cell int, q_lo double, q_hi double"
    )
    reaches = (F.col("lo") <= F.col("q_hi")) & (F.col("hi") >= F.col("q_lo"))
    home = topk.kept(
        directory.join(wanted, "cell").where(reaches).groupBy("q_block", "cell")
        .agg(F.min("block").alias("block")).select("q_block", "block").distinct(),
        "home-pairs",
    )

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = topk.Best(k)
        for batch in batches:
            for row in batch.itertuples(index=False):
                search.block(row, best)
                if best.full():
                    yield best.lists()
        yield best.lists()

    def compare(pairs: DataFrame, asked: DataFrame) -> DataFrame:
        joined = pairs.join(asked, "q_block").join(index, "block").select(
            "q_ids", "q_xs", "q_dists", "floors", "ids", "xs", "cells", "dists"
        )
        return joined.mapInPandas(searched, topk.FOUND)

    first = topk.kept(
        compare(home, queries.withColumn("floors", F.lit(None).cast("binary"))), "home-found"
    )
    floors = topk.ranked(topk.merged(first, k)).where(F.col("rank") == k).select(
        "query_id", F.col("score").alias("floor")
    )

    # the floor of each query goes back to its block
    ids = queries.select("q_block", "q_ids")

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b, q in zip(batch["q_block"], batch["q_ids"]):
                v = np.frombuffer(q, "<i8")
                yield pd.DataFrame({"q_block": b, "place": np.arange(len(v)), "query_id": v})

    placed = (
        ids.mapInPandas(listed, "q_block long, place int, query_id long")
        .join(floors, "query_id", "left")
        .groupBy("q_block")
        .agg(F.sort_array(F.collect_list(F.struct("place", "floor"))).alias("f"))
        .select("q_block", F.col("f.floor").alias("floor_list"))
    )

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                np.array([-np.inf if v is None or v != v else v for v in f], "<f8").tobytes()
                for f in batch["floor_list"]
            ]
            yield batch.drop(columns="floor_list").assign(floors=out)

    bounded = topk.kept(
        queries.join(placed, "q_block").mapInPandas(
            packed,
            "q_block long, q_ids binary, q_xs binary, q_cells binary, q_own binary, "
            "q_dists binary, floors binary",
        ),
        "query-floors",
    )

    def annuli(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                q = search.values(row.q_xs)
                away = np.frombuffer(row.q_dists, "<f8").reshape(len(q), len(pivots))
                floor = np.frombuffer(row.floors, "<f8")
                t = search.reach((q * q).sum(axis=1), floor)[:, None]
                yield pd.DataFrame(
                    {
                        "q_block": row.q_block,
                        "cell": np.arange(len(pivots), dtype=np.int32),
                        "q_lo": (away - t).min(axis=0),
                        "q_hi": (away + t).max(axis=0),
                    }
                )

    reached = bounded.select("q_block", "q_xs", "q_dists", "floors").mapInPandas(
        annuli, "q_block long, cell int, q_lo double, q_hi double"
    )
    rest = (
        directory.join(reached, "cell").where(reaches).select("q_block", "block").distinct()
        .join(home, ["q_block", "block"], "left_anti")
    )
    second = compare(rest, bounded)
    found = topk.ranked(topk.merged(first.union(second), k))
    return found.withColumn("score", F.col("score").cast("long"))
