"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by the slots of width w that its projections on random
normal directions fall into. For a neighbour at distance r, the difference of
each projection is normal with deviation r, so the chance that it lies in a
given bucket is a product of normal probabilities. A query visits the likeliest
buckets of each table, until the chances add up to what the wanted recall takes.
r is estimated per query from a bounded sample; where that is not the whole
table, queries go to their likeliest bucket first, and the k-th vector found
there bounds r. Candidates of all tables are compared by their exact inner product.

What a query keeps of this is the least chance of a bucket that it visits: its
buckets are never listed, as there may be millions. A task holds a group of
queries, in the order of their buckets, and reads a part of the index from the
shared folder, block by block. Buckets with the same first slots are a cell, and
a block is of one cell: what its slots at best allow rules out most queries that
visit none of its buckets.

Vectors are lifted to a common norm (topk.lifted), where the nearest one has the
largest inner product, and queries are scaled to that norm.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from pagemill.llm import store, topk
from pagemill.sources import files

TABLES = 1  # by the recall, one table that misses no more compares fewer vectors than three together
MISSED = 0.01  # share of neighbours that the estimate lets go
SAMPLE = 2048  # vectors from which widths and distances are estimated
BLOCK_ROWS = 4096
QUERY_ROWS = 512  # queries of a group at least
GROUP_BYTES = 8 << 20  # of the queries that a task holds at once
AT_ONCE = 1024  # queries compared with a block at once
INDEX_TASKS = 256  # beyond so many, a task makes up to 16 blocks
BUCKET_ROWS = 256  # about the vectors in a bucket, which sets the number of projections
CELL_SLOTS = 3  # projections that make a cell
LEAST_SLOT = 1e-4  # chance of a slot below which its buckets are left out
LISTED = 4096  # buckets that are listed for their least chance, more are counted by their chance
STEP, STEPS = 1 / 16, 512  # of that count: in natural logarithms
SEED = 7


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    """By the complementary error function's rational approximation (error below 1.5e-7)."""
    z = np.abs(x) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * z)
    # fixed values: coefficients of the approximation
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = poly * np.exp(-z * z) / 2
    return np.where(x > 0, 1 - tail, tail)


class _Tables:
    """Directions, offsets and widths of all tables, and the buckets a query visits."""

    def __init__(self, sample: np.ndarray, n: int, square: float, k: int):
        self.square, self.n, self.k = square, n, k
        count = max(1, round(math.log(max(n, 2) / BUCKET_ROWS) / math.log(3))) if n else 1
        self.count = min(count, 8)
        rng = np.random.default_rng(SEED)
        self.sample = topk.lifted(sample, square)
        dim = self.sample.shape[1]
        self.directions = rng.normal(size=(TABLES, dim, self.count))
        spread = [(self.sample @ d).std(axis=0) for d in self.directions] if n else 1.0
        self.width = 1.5 * np.maximum(np.broadcast_to(spread, (TABLES, self.count)), 1e-12)
        self.offset = rng.random((TABLES, self.count)) * self.width
        self.target = 1 - MISSED ** (1 / TABLES)
        self.bits = min(62 // self.count, 30)  # of a slot in a bucket's number
        self.shift = self.bits * max(0, self.count - CELL_SLOTS)

    def places(self, x: np.ndarray, table: int) -> np.ndarray:
        """Projections in units of slots."""
        return (x @ self.directions[table] + self.offset[table]) / self.width[table]

    def bucket(self, slots: np.ndarray) -> np.ndarray:
        """One number for the slots of a bucket, in their order; the outermost slots are open."""
        half = 1 << (self.bits - 1)
        number = np.zeros(slots.shape[:-1], np.int64)
        for i in range(slots.shape[-1]):
            slot = np.clip(slots[..., i], -half, half - 1).astype(np.int64)
            number = (number << self.bits) | (slot + half)
        return number

    def cell(self, bucket: np.ndarray) -> np.ndarray:
        return bucket >> self.shift

    def slots(self, bucket: np.ndarray) -> np.ndarray:
        """The slots that a bucket's number stands for."""
        half, mask = 1 << (self.bits - 1), (1 << self.bits) - 1
        shifts = self.bits * np.arange(self.count - 1, -1, -1)
        return ((bucket[:, None] >> shifts) & mask) - half

    def distance(self, q: np.ndarray) -> np.ndarray:
        """About the distance of each query's k-th neighbour, rather too large than too small."""
        m = len(self.sample)
        squares = (q * q).sum(axis=1)[:, None] + self.square - 2 * q @ self.sample.T
        place = min(m - 1, math.ceil(self.k * m / max(self.n, 1)))  # one more: a query itself
        return np.sqrt(np.maximum(np.partition(squares, place, axis=1)[:, place], 1e-18))

    def _near(self, at: np.ndarray, r: np.ndarray, table: int) -> Iterator[list[tuple]]:
        """For each query and projection, slots that hold a neighbour with some chance, and that."""
        found = []
        for p, w in zip(at.T, self.width[table]):
            lo, hi = np.floor(p - 4 * r / w), np.floor(p + 4 * r / w)
            s = lo[:, None] + np.arange(int((hi - lo).max(initial=0)) + 2)
            here = np.diff(_normal_cdf((s - p[:, None]) * w / r[:, None]), axis=1)
            found.append((s[:, :-1].astype(np.int64), here, here > LEAST_SLOT))
        for j in range(len(at)):
            yield [(s[j, some[j]], here[j, some[j]]) for s, here, some in found]

    def _likeliest(self, near: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Chances and slots of the likeliest buckets, in this order, until they reach the target."""
        chances, slots = np.ones(1), np.zeros((1, 0), np.int64)
        for s, here in near:
            chances = (chances[:, None] * here).ravel()
            slots = np.column_stack([np.repeat(slots, len(s), axis=0), np.tile(s, len(slots))])
            # beginnings that hardly any wanted bucket has go at once
            order = np.argsort(-chances, kind="stable")
            keep = 1 + int(np.searchsorted(np.cumsum(chances[order]), 0.999 * chances.sum()))
            chances, slots = chances[order[:keep]], slots[order[:keep]]
        enough = int(np.searchsorted(np.cumsum(chances), self.target)) + 1
        return chances[:enough], slots[:enough]

    def _counted(self, near: list[tuple]) -> float:
        """The log of the least chance by the distribution of the chances' logs, which are rounded
        down: buckets that reach it have the target's chance together at least."""
        shares = np.zeros(STEPS)
        shares[0] = 1
        for _, here in near:
            before, shares = shares, np.zeros(STEPS)
            for by, chance in zip(np.ceil(-np.log(here) / STEP).astype(int), here):
                shares[by:] += chance * before[: STEPS - by]
        place = int(np.searchsorted(np.cumsum(shares), self.target))
        return -place * STEP if place < STEPS else -math.inf

    def probes(self, q: np.ndarray, table: int) -> list[np.ndarray]:
        """Buckets of each query, the likeliest ones, in their order."""
        near = self._near(self.places(q, table), self.distance(q), table)
        return [np.unique(self.bucket(self._likeliest(n)[1])) for n in near]

    def least(self, at: np.ndarray, r: np.ndarray, table: int, home: bool) -> np.ndarray:
        """The log of the chance that a bucket must have for a query at `at` to visit it, of a
        neighbour at distance r; without a bound where slots are tiny beside that distance.

        home: the likeliest bucket only, which a query lies in itself."""
        out = np.full(len(at), -math.inf)
        by = self.width[table] / r[:, None]
        bounded = np.flatnonzero((by >= 1 / 8).all(axis=1))
        if home:
            at, by = at[bounded], by[bounded]
            own = _normal_cdf((np.floor(at) + 1 - at) * by) - _normal_cdf((np.floor(at) - at) * by)
            out[bounded] = np.log(own).sum(axis=1) - 1e-9  # a log of a product is not exact
            return out
        for j, near in zip(bounded, self._near(at[bounded], r[bounded], table)):
            if math.prod(len(s) for s, _ in near) <= LISTED:
                out[j] = math.log(self._likeliest(near)[0][-1]) - 1e-9
            else:
                out[j] = self._counted(near)
        return out


class _Asked:
    """A group of queries, and which buckets each visits."""

    def __init__(
        self, tables: _Tables, ids: np.ndarray, q: np.ndarray, scaled: np.ndarray, r: np.ndarray, least: np.ndarray
    ):
        self.tables, self.ids, self.q, self.r, self.bounds = tables, ids, q, r, least
        self.norms = np.sqrt(np.square(q, dtype=np.float64).sum(axis=1))
        self.at = [tables.places(scaled, t) for t in range(TABLES)]
        self._held: dict[tuple, np.ndarray] = {}

    def _chance(self, table: int, i: int, slot: int) -> np.ndarray:
        """The log of each query's chance of a slot; of none if that is hardly any."""
        found = self._held.get((table, i, slot))
        if found is None:
            if len(self._held) >= 128:
                self._held.clear()
            half, by = 1 << (self.tables.bits - 1), self.tables.width[table, i] / self.r
            ends = [
                _normal_cdf((slot + 1 - self.at[table][:, i]) * by) if slot < half - 1 else 1.0,
                _normal_cdf((slot - self.at[table][:, i]) * by) if slot > -half else 0.0,
            ]
            chance = np.broadcast_to(ends[0] - ends[1], len(self.r))
            found = np.full(len(self.r), -math.inf)
            np.log(chance, out=found, where=chance > LEAST_SLOT)
            self._held[table, i, slot] = found
        return found

    def visits(self, table: int, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries that visit some of the buckets, and by query and bucket whether it does."""
        columns = []
        for i, slots in enumerate(self.tables.slots(buckets).T):
            each, place = np.unique(slots, return_inverse=True)
            columns.append(([self._chance(table, i, int(s)) for s in each], place))
        bound = self.bounds[:, table]
        asking = np.flatnonzero(sum(np.max(c, axis=0) for c, _ in columns) >= bound)
        chances = np.zeros((len(asking), len(buckets)))
        for chance, place in columns:
            chances += np.column_stack([c[asking] for c in chance])[:, place]
        visits = chances >= bound[asking, None]
        some = visits.any(axis=1)
        return asking[some], visits[some]


def _exact(q: np.ndarray, x: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Inner products of pairs, summed in the order of the components: equal vectors get equal
    scores in whatever block they are."""
    total = np.zeros(len(rows))
    for a in range(0, len(rows), 1 << 15):
        part = slice(a, a + (1 << 15))
        products = q[rows[part]].astype(np.float64) * x[columns[part]]
        for i in range(q.shape[1]):
            total[part] += products[:, i]
    return total


def _add_best(
    best: topk.Best, q_ids: np.ndarray, q: np.ndarray, slack: np.ndarray, floor: np.ndarray,
    ids: np.ndarray, x: np.ndarray, visits: np.ndarray | None, bucket: np.ndarray | None,
) -> None:
    """Add what the queries find among the vectors of a block in the buckets they visit.

    A product of matrices is off the exact score by `slack` at most; scores below `floor` do
    not matter.
    """
    slots = best.slots(q_ids)
    scores = q @ x.T
    least = np.maximum(best.least(slots), floor) - slack

    def reached() -> tuple[np.ndarray, np.ndarray]:
        # in the products' own precision, rounded down: comparing is as much work as multiplying
        bar = np.nextafter(least.astype(scores.dtype), -np.inf, dtype=scores.dtype)
        bar = np.maximum(bar, np.finfo(scores.dtype).min)
        return np.divmod(np.flatnonzero(scores >= bar[:, None]), scores.shape[1])

    at, column = reached()
    if len(at) > 2 * best.k * len(q):  # at first: no bound yet
        scores[q_ids[:, None] == ids] = -np.inf
        if visits is not None:
            scores[~visits[:, bucket]] = -np.inf
        if scores.shape[1] > best.k:
            kth = np.partition(scores, scores.shape[1] - best.k, axis=1)[:, -best.k]
            least = np.maximum(least, kth - 2 * slack)
        at, column = reached()
    fine = q_ids[at] != ids[column]
    if visits is not None:
        fine &= visits[at, bucket[column]]
    at, column = at[fine], column[fine]
    best.add(slots[at], ids[column], _exact(q, x, at, column))


def lsh_top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest found, by inner product.

    Ties go to the smaller vec_id. Rows that share the query's vec_id are its
    own; vectors that share an id count as one with their best score. Shorter
    vectors are continued with zeros. A query for which fewer than k were found is
    compared with all rows. See topk.valid_vectors for rows that take no part (zero vectors
    neither); an empty table gives no rows.
    """
    rows = topk.kept(
        topk.valid_vectors(vectors, value=lambda c: c, zero=False).withColumn(
            "is_query", is_query
        ),
        "vectors",
    )
    n, dim, square = topk.measures(rows)
    tables = _Tables(topk.sample(rows, SAMPLE, dim), n, square, k)

    single = isinstance(vectors.schema["embedding"].dataType.elementType, FloatType)
    kind = "<f4" if single else "<f8"  # as they came: nothing is lost

    def as_rows(x: np.ndarray) -> list[bytes]:
        data, size = x.astype(kind).tobytes(), dim * np.dtype(kind).itemsize
        return [data[at : at + size] for at in range(0, len(data), size)]

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = topk.matrix(batch["v"], dim)
            up = topk.lifted(x, square)
            data = as_rows(x)
            for t in range(TABLES):
                bucket = tables.bucket(np.floor(tables.places(up, t)))
                cell = tables.cell(bucket)
                yield pd.DataFrame(
                    {"tab": t, "cell": cell, "bucket": bucket, "vec_id": batch["vec_id"], "x": data}
                )

    total = TABLES * n
    blocks = -(-total // BLOCK_ROWS)
    index = topk.kept(
        topk.blocks(
            rows.select("vec_id", "v").mapInPandas(
                hashed, "tab int, cell long, bucket long, vec_id long, x binary"
            ),
            ["tab", "bucket", "vec_id"], BLOCK_ROWS, total, ["tab", "cell"],
            "tab int, cell long, block long, ids binary, xs binary, bucket binary",
            tasks=min(blocks, max(INDEX_TASKS, blocks // 16)),
        ),
        "lsh-index",
    )
    asked = rows.where("is_query").select("vec_id", "v")
    n_asked = asked.count()
    spark = vectors.sparkSession
    parallel = 4 * spark.sparkContext.defaultParallelism

    def values(data: bytes) -> np.ndarray:
        return np.frombuffer(data, kind).reshape(-1, dim)

    def scaled(q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        norms = np.sqrt((q * q).sum(axis=1))
        return np.column_stack([q * (np.sqrt(square) / norms)[:, None], np.zeros(len(q))])

    def ordered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = topk.matrix(batch["v"], dim)
            bucket = tables.bucket(np.floor(tables.places(scaled(x), 0)))
            floor = batch["floor"].astype("f8").fillna(-np.inf)
            yield pd.DataFrame(
                {"bucket": bucket, "vec_id": batch["vec_id"], "x": as_rows(x), "floor": floor}
            )

    def probing(everything: bool, home: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                reach, least = [], []
                for xs, floor in zip(batch["xs"], batch["floor"]):
                    up, floor = scaled(values(xs)), np.frombuffer(floor)
                    few = [slice(a, a + AT_ONCE) for a in range(0, len(up), AT_ONCE)]
                    r = np.concatenate([tables.distance(up[part]) for part in few])
                    # what reaches the floor is no farther than this
                    norms = np.sqrt(np.square(values(xs), dtype=np.float64).sum(axis=1))
                    squares = 2 * square - 2 * floor * np.sqrt(square) / norms
                    r = np.minimum(r, np.sqrt(np.maximum(squares, 1e-18)))
                    bounds = np.full((len(up), TABLES), -math.inf)
                    if not everything:
                        for t, part in itertools.product(range(TABLES), few):
                            at = tables.places(up[part], t)
                            bounds[part, t] = tables.least(at, r[part], t, home)
                    reach.append(r.tobytes())
                    least.append(bounds.tobytes())
                yield batch[["ids", "xs", "floor"]].assign(reach=reach, least=least)
                store.give_back()

        return run

    def searched(query_files: list[str], parts: list[list[str]], everything: bool):
        def read(path: str) -> Iterator:
            with files.open_input(path) as file:
                for batch in pq.ParquetFile(file).iter_batches(4):
                    yield from batch.to_pylist()

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for number in (i for batch in batches for i in batch["id"]):
                for row in read(query_files[number // len(parts)]):
                    yield found(row, parts[number % len(parts)])
                    store.give_back()

        def found(row: dict, paths: list[str]) -> pd.DataFrame:
            q, best = values(row["xs"]), topk.Best(k)
            asked = _Asked(
                tables, np.frombuffer(row["ids"], "<i8"), q, scaled(q), np.frombuffer(row["reach"]),
                np.frombuffer(row["least"]).reshape(-1, TABLES),
            )
            # products of floats in their own precision, where it neither ends nor overflows
            small = single and 1e-20 < square < 1e30
            slack = (1e-6 if small else 1e-12) * math.sqrt(square) * asked.norms * dim + 1e-36 * small
            q = q if small else q.astype(np.float64)
            floor = np.frombuffer(row["floor"])
            for block in (b for path in paths for b in read(path)):
                if everything and block["tab"]:
                    continue
                ids, x = np.frombuffer(block["ids"], "<i8"), values(block["xs"]).astype(q.dtype, copy=False)
                if everything:
                    asking, visits = np.arange(len(q)), None
                else:
                    buckets, place = np.unique(np.frombuffer(block["bucket"], "<i8"), return_inverse=True)
                    asking, visits = asked.visits(block["tab"], buckets)
                for a in range(0, len(asking), AT_ONCE):
                    who = asking[a : a + AT_ONCE]
                    given = asked.ids[who], q[who], slack[who], floor[who]
                    if everything:
                        _add_best(best, *given, ids, x, None, None)
                        continue
                    here = visits[a : a + AT_ONCE]
                    wanted = here.any(axis=0)[place]
                    _add_best(best, *given, ids[wanted], x[wanted], here, place[wanted])
            return best.lists()

        return run

    index_files = [unquote(f) for f in sorted(index.inputFiles())]

    def search(asked: DataFrame, count: int, everything: bool = False, home: bool = False) -> DataFrame:
        """Lists that tasks find: each has a group of the queries and a part of the index."""
        size = min(max(-(-count // parallel), QUERY_ROWS), max(QUERY_ROWS, GROUP_BYTES // (8 * dim)))
        queries = topk.kept(
            topk.blocks(
                asked.mapInPandas(ordered, "bucket long, vec_id long, x binary, floor double"),
                ["bucket", "vec_id"], size, count, [], "block long, ids binary, xs binary, floor binary",
            ).mapInPandas(
                probing(everything, home),
                "ids binary, xs binary, floor binary, reach binary, least binary",
            ),
            "lsh-queries",
        )
        query_files = [unquote(f) for f in sorted(queries.inputFiles())]
        n_parts = max(1, min(len(index_files), max(8, -(-parallel // max(1, len(query_files))))))
        parts = [index_files[i::n_parts] for i in range(n_parts)]
        tasks = len(query_files) * n_parts
        return spark.range(0, tasks, 1, max(1, tasks)).mapInPandas(
            searched(query_files, parts, everything), topk.FOUND
        )

    unbounded = asked.withColumn("floor", F.lit(None).cast("double"))
    if n <= SAMPLE:  # the distances are known
        found = search(unbounded, n_asked)
    else:
        first = topk.kept(topk.merged(search(unbounded, n_asked, home=True), k), "lsh-home")
        floors = topk.ranked(first).where(F.col("rank") == k).selectExpr("query_id", "score AS floor")
        bounded = asked.join(floors, F.col("vec_id") == F.col("query_id"), "left").drop("query_id")
        found = first.union(search(bounded, n_asked))
    lists = topk.kept(topk.merged(found, k), "lsh-lists")

    # queries with too few: against all rows, which one table holds once
    enough = lists.where(F.length("ids") >= 8 * k).select("query_id")
    if enough.count() < n_asked:
        short = topk.kept(
            unbounded.join(enough, F.col("vec_id") == F.col("query_id"), "left_anti"), "lsh-short"
        )
        found = search(short, short.count(), everything=True)
        lists = topk.kept(topk.merged(lists.union(found), k), "lsh-lists")
    return topk.ranked(lists)
