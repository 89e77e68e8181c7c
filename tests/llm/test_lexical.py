import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import lexical
from pagemill.llm.lexical import rank_documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def expected(documents, items, k=10):
    counted = [(doc, Counter(terms(text))) for doc, text in documents]
    n_all = sum(bool(c) for _, c in counted)
    length = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counted:
            m = 10 + (90 * sum(c.values()) * n_all) // length if c else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if null else doc, -score))
    return sorted(out, key=str)


def items_of(spark, rows):
    frame = spark.createDataFrame(rows, "item_id long, text string")
    for name in ("item", "term", "terms", "rank", "score", "doc_id", "weight", "part"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame


SMALL = {"slab_terms": 7, "block_documents": 5, "tile_items": 3, "tile_terms": 20}


@pytest.mark.parametrize("more", [{}, SMALL, {"k": 3, **SMALL}])
def test_against_brute_force(spark, documents, more, monkeypatch):
    if more:
        monkeypatch.setattr(lexical, "WIDTH", 4)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["É", "été", "ÀB", "naïve", "日本", "x9"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(120)]
    docs += [(500 + i, "W1 w2,w3;W3") for i in range(30)]  # ties
    docs += [(None, "w1 w2 w3"), (None, "w1 w2 w3"), (3, "w5"), (3, "w5"), (600, None), (601, ""), (602, " \0.!{}~\x7f")]
    docs += [(700, "w1 " * 100_000 + "w2")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 8)))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "unknown terms only"), (53, "w1 W1 w1"), (53, "w1"), (53, "w1"), (None, "w2-w3")]
    items += [(54, " ".join(words))]  # more terms than a tile
    found = rank_documents(documents(docs), items_of(spark, items), **more).collect()
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found), key=str)
    assert got == expected(docs, items, more.get("k", 10))


def test_nothing_to_rank(spark, documents):
    none = items_of(spark, [])
    assert rank_documents(documents([(1, "a")]), none).count() == 0
    assert rank_documents(documents([]), items_of(spark, [(1, "a")])).count() == 0
    assert rank_documents(documents([(1, ".")]), items_of(spark, [(1, "a")])).count() == 0


def test_sums_stay_exact():
    """Weights so large that only a few terms fit below 2^53 at a time."""
    n = 300
    weight = np.full(n, 10**9, np.int64)
    tile = {
        "items": np.array([7]), "vocabulary": np.arange(n), "row": np.zeros(n, np.int32),
        "column": np.arange(n, dtype=np.int32), "weight": weight,
    }
    block = {
        "ids": np.array([1]), "terms": np.arange(n), "document": np.zeros(n, np.int32),
        "column": np.arange(n, dtype=np.int32),
    }
    impact = np.arange(999_700, 1_000_000)
    assert lexical._scores(tile, block, impact).tolist() == [[int((weight * impact).sum())]]
    with pytest.raises(OverflowError):
        lexical._scores({**tile, "weight": weight * 10**6}, block, impact)


def test_best_of_a_tile():
    scores = np.array([[5, 9, 5, 5, 0], [0, 0, 0, 0, 0], [1, 1, 1, 1, 1]])
    row, column = lexical._best(scores, 2)
    assert list(zip(row.tolist(), column.tolist())) == [(0, 0), (0, 1), (2, 0), (2, 1)]
