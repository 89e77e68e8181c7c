import random

import numpy as np

from pagemill.llm import near_dup
from pagemill.llm.near_dup import near_duplicates, signatures, without_near_duplicates


def brute(rows, similarity=0.8):
    """class_id per row, by all pairs."""
    words = [tuple((t or "").split()) for _, t in rows]
    sets = [
        [w[i : i + 5] for i in range(len(w) - 4)] or ([w] if w else []) for w in words
    ]
    n = len(rows)
    df = {}
    for s in sets:
        for x in set(s):
            df[x] = df.get(x, 0) + 1
    weight = {x: float(near_dup.idf(np.array(d), n)) for x, d in df.items()}
    label = list(range(n))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            keys = set(sets[i]) | set(sets[j])
            if not keys:
                continue
            least = sum(min(sets[i].count(x), sets[j].count(x)) * weight[x] for x in keys)
            most = sum(max(sets[i].count(x), sets[j].count(x)) * weight[x] for x in keys)
            if least / most >= similarity:
                label[root(i)] = root(j)
    groups = {}
    for i in range(n):
        groups.setdefault(root(i), []).append(rows[i][0])
    return sorted(
        ((rows[i][0], min(groups[root(i)], key=lambda k: (k is None, k or 0))) for i in range(n)),
        key=str,
    )


def edited(words, edits, rng):
    out = list(words)
    for i in rng.sample(range(len(out)), edits):
        out[i] = f"e{rng.random():.9f}"
    return " ".join(out)


def corpus():
    rng = random.Random(5)
    rows, key = [], 0
    for group in range(6):
        base = [f"g{group}w{rng.randrange(10**6)}" for _ in range(150)]
        rows.append((key := key + 1, " ".join(base)))
        for _ in range(12):
            rows.append((key := key + 1, edited(base, rng.choice([0, 1, 2, 3, 4, 8, 15]), rng)))
    passage = " ".join(f"p{i}" for i in range(40))
    for i in range(10):
        own = " ".join(f"o{i}x{j}" for j in range(60))
        rows.append((key := key + 1, f"{own} {passage}"))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "a b c"), (904, "a  b\tc"), (905, "a b"),
             (None, rows[0][1]), (1, rows[0][1]), (906, "z " * 3000), (907, "z " * 3000)]
    return rows


def test_classes_against_brute_force(documents):
    rows = corpus()
    found = near_duplicates(documents(rows), chunk_bytes=4000).collect()
    assert sorted(((r.doc_id, r.class_id) for r in found), key=str) == brute(rows)


def test_one_of_each_class_stays(documents):
    rows = corpus()
    kept = without_near_duplicates(documents(rows))
    got = sorted(r.doc_id for r in kept.collect())
    assert got == sorted({c for _, c in brute(rows)})
    assert kept.columns == documents(rows).columns


def test_rows_with_one_id_and_different_texts(documents):
    a, b = " ".join(f"a{i}" for i in range(20)), " ".join(f"b{i}" for i in range(20))
    rows = [(1, a), (2, b), (2, a), (3, b)]
    kept = without_near_duplicates(documents(rows)).collect()
    assert sorted((r.doc_id, r.text[0]) for r in kept) == [(1, "a"), (2, "b")]


def test_no_rows(documents):
    assert near_duplicates(documents([])).count() == 0
    assert without_near_duplicates(documents([])).count() == 0


def test_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(1)
    shared = rng.integers(1, 1 << 63, 400).astype(np.uint64)
    # both have 300 of the shared shingles, 200 of them in common, and some of their own
    sets = [shared[:300], shared[100:]]
    w = [np.full(300, 1.2), np.full(300, 1.2)]
    own = np.array([11, 22], np.uint64)
    out = signatures(
        np.concatenate(sets), np.concatenate(w), np.array([0, 300, 600]), own,
        np.array([60.0, 30.0]), 4000,
    )
    expected = 200 * 1.2 / (400 * 1.2 + 90)
    assert abs((out[0] == out[1]).mean() - expected) < 0.03
