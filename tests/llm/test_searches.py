import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import lsh_search, pivot_search, topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, is_query string, x string"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)).astype(np.float32) * rng.uniform(0.2, 1, (1500, 1))
    x[700:1100] = x[700]  # a hot vector
    return np.round(x, 3).astype(np.float32)


def frame(spark, vectors, more=()):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)] + list(more)
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], SCHEMA)


def brute(x, ids, queries, k):
    scores = x[queries] @ x.T
    out = {}
    for row, q in zip(scores, queries):
        order = [i for i in np.lexsort((ids, -row)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), row[i]) for i in order]
    return out


ODD = [
    (None, [1.0] * 16), (5000, None), (5001, [None] * 16), (5002, [float("nan")] * 16),
    (5003, [float("inf")] * 16), (5004, []), (3, None),
]


def test_exact(spark, vectors, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK_ROWS", 200)
    monkeypatch.setattr(pivot_search, "QUERY_ROWS", 16)
    monkeypatch.setattr(pivot_search, "ANNULUS_ROWS", 50)
    data = frame(spark, vectors, [*ODD, (0, [float(c) for c in vectors[0]])])
    found = pivot_search.pivot_top_k(data, F.col("vec_id") % 20 == 0, 20).collect()
    x = np.floor(64 * vectors.astype(np.float64))
    wanted = brute(x, np.arange(len(x)), np.arange(0, len(x), 20), 20)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == wanted


def test_approximate(spark, vectors):
    data = frame(spark, vectors, ODD)
    found = lsh_search.lsh_top_k(data, F.col("vec_id") % 20 == 0, 20).collect()
    x = vectors.astype(np.float64)
    wanted = brute(x, np.arange(len(x)), np.arange(0, len(x), 20), 20)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        assert r.score == pytest.approx(x[r.query_id] @ x[r.vec_id], abs=1e-12)
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got.keys() == wanted.keys() and all(len(v) == 20 for v in got.values())
    recall = np.mean([len({i for i, _ in wanted[q]} & set(got[q])) / 20 for q in wanted])
    assert recall >= 0.9


def test_a_query_meets_a_vector_once_and_a_cell_has_many_buckets(monkeypatch):
    monkeypatch.setattr(lsh_search, "BUCKET_ROWS", 8)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    tables = lsh_search._Tables(x[:500], len(x), 1.0, 20)
    up, q = topk.lifted(x, 1.0), np.column_stack([x[:40], np.zeros(40)])
    compared, copies, visits = 0, 0, 0
    for t in range(lsh_search.TABLES):
        bucket = tables.bucket(np.floor(tables.places(up, t)))
        for probed in tables.probes(q, t):
            compared += np.isin(bucket, probed).sum()
            visits += len(probed)
            copies += len(np.unique(tables.cell(probed)))
    assert compared <= len(q) * len(x)
    assert copies * 3 <= visits
    # numbers of buckets keep the order of their slots, however far out these are
    slots = np.sort(rng.integers(-3, 3, 500))[:, None] + np.zeros(tables.count)
    assert (np.diff(tables.bucket(slots)) >= 0).all()
    far = np.array([[-1e30] * tables.count, [1e30] * tables.count])
    assert tables.bucket(far)[0] == 0 < tables.bucket(far)[1]


def test_buckets_are_visited_by_their_chance(monkeypatch):
    """Those that a list of the likeliest ones has; counted chances let go of none."""
    monkeypatch.setattr(lsh_search, "BUCKET_ROWS", 8)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(800, 32))
    x[400:] = x[:400] + rng.normal(size=(400, 32)) * 0.05
    x /= np.linalg.norm(x, axis=1)[:, None]
    tables = lsh_search._Tables(x, len(x), 1.0, 5)
    assert tables.count == 4
    buckets = np.unique(tables.bucket(np.floor(tables.places(topk.lifted(x, 1.0), 0))))
    assert (tables.bucket(tables.slots(buckets)) == buckets).all()
    q = np.column_stack([x[:60], np.zeros(60)])
    at, r = tables.places(q, 0), tables.distance(q)
    listed = np.array([np.isin(buckets, probed) for probed in tables.probes(q, 0)])

    def visited(home):
        least = tables.least(at, r, 0, home)[:, None]
        found = np.zeros(listed.shape, bool)
        asking, visits = lsh_search._Asked(tables, np.arange(60), x[:60], q, r, least).visits(0, buckets)
        found[asking] = visits
        return found

    assert (visited(False) == listed).all() and listed.any(axis=1).all()
    own = tables.bucket(np.floor(at))[:, None] == buckets
    assert (visited(True) == own).all()
    monkeypatch.setattr(lsh_search, "LISTED", 0)
    counted = visited(False)
    assert (counted >= listed).all() and counted.sum() < 1.3 * listed.sum()


@pytest.mark.parametrize("kind", ["float", "double"])
def test_a_first_round_bounds_the_distance(spark, monkeypatch, kind):
    # 30 near copies of each vector, of which the sample has few
    monkeypatch.setattr(lsh_search, "SAMPLE", 64)
    monkeypatch.setattr(lsh_search, "BUCKET_ROWS", 16)
    monkeypatch.setattr(lsh_search, "QUERY_ROWS", 30)
    rng = np.random.default_rng(9)
    x = np.tile(rng.normal(size=(100, 16)), (30, 1)) + rng.normal(size=(3000, 16)) * 0.01
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)
    data = frame(spark, x, ODD).withColumn("embedding", F.col("embedding").cast(f"array<{kind}>"))
    found = lsh_search.lsh_top_k(data, F.col("vec_id") % 20 == 0, 20).collect()
    wanted = brute(x.astype(np.float64), np.arange(3000), np.arange(0, 3000, 20), 20)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got.keys() == wanted.keys() and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in wanted[q]} & set(got[q])) / 20 for q in wanted]) >= 0.95


def test_short_lists_are_completed(spark, monkeypatch):
    # every vector in a bucket of its own, of which a query visits few
    monkeypatch.setattr(lsh_search, "MISSED", 0.999)
    monkeypatch.setattr(lsh_search, "BUCKET_ROWS", 1)
    x = np.round(np.random.default_rng(6).normal(size=(200, 8)), 3).astype(np.float32)
    found = lsh_search.lsh_top_k(frame(spark, x), F.col("vec_id") % 20 == 0, 150).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    wanted = brute(x.astype(np.float64), np.arange(200), np.arange(0, 200, 20), 150)
    assert got == {q: [i for i, _ in v] for q, v in wanted.items()}


@pytest.mark.parametrize("search", [pivot_search.pivot_top_k, lsh_search.lsh_top_k])
def test_few_rows(spark, search):
    everything = F.col("vec_id") >= 0
    assert search(frame(spark, []), everything, 20).count() == 0
    one = frame(spark, [], [(0, [1.0, 2.0])])
    assert search(one, everything, 20).count() == 0
    three = frame(spark, [], [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0]), (1, [1.0, 2.0])])
    got = [(r.query_id, r.rank, r.vec_id) for r in search(three, everything, 20).collect()]
    assert sorted(got) == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 0), (2, 2, 1)]


@pytest.mark.parametrize("ids", ["id", "0L"])
def test_a_sample_does_not_send_rows_of_every_task_to_the_driver(spark, ids):
    # 16 tasks with 256 KB of the vectors with the smallest hashes each
    rows = spark.range(0, 960, 1, 16).selectExpr(
        f"{ids} AS vec_id", "transform(sequence(1, 1024), i -> double(id * 7919 % 977) + i / 1e4) AS v"
    )
    conf = spark.sparkContext._jsc.sc().conf()
    wanted = rows.selectExpr("xxhash64(vec_id) AS h", "vec_id", "v[0] AS first").toPandas()
    wanted = wanted.sort_values(["h", "vec_id", "first"])["first"][:32]
    conf.set("spark.driver.maxResultSize", "1m")
    try:
        found = topk.sample(rows, 32, 1024)
    finally:
        conf.remove("spark.driver.maxResultSize")
    assert found.shape == (32, 1024)
    assert found[:, 0].tolist() == wanted.tolist()
    assert len(topk.sample(rows.limit(5), 32, 1024)) == 5


def test_best_lists_merge():
    best = topk.Best(2)
    slots = best.slots(np.array([7, 9]))
    best.add(slots[[0, 0, 0]], np.array([1, 2, 3]), np.array([5.0, 5.0, 4.0]))
    best.add(slots[[0, 0, 1]], np.array([2, 0, 4]), np.array([5.0, 5.0, 1.0]))
    rows = [
        (q, np.frombuffer(i, "<i8").tolist(), np.frombuffer(s, "<f8").tolist())
        for q, i, s in best.lists().values.tolist()
    ]
    assert rows == [(7, [0, 1], [5.0, 5.0]), (9, [4], [1.0])]
