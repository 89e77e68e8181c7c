import random
import re

import numpy as np
import pytest

from pagemill.llm import queries
from pagemill.llm.periodic import periodic_runs
from pagemill.llm.squares import SquareCatcher


def brute(w, exponent=4, least=6):
    """All stretches of every period, by comparing words; the smallest period of each stretch."""
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, exponent * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def sequence(rng):
    n, letters = rng.randint(0, 100), rng.choice([1, 2, 3, 5])
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n:
            a, p = rng.randrange(n), rng.randint(1, 20)
            for i in range(a, min(n, a + p * rng.randint(3, 8))):
                w[i] = w[a + (i - a) % p]
    return w


@pytest.mark.parametrize("exponent, least", [(2, 1), (3, 6), (4, 6), (5, 1)])
def test_catcher_against_brute_force(exponent, least):
    rng = random.Random(exponent)
    for _ in range(300):
        w = sequence(rng)
        want = brute(w, exponent, least)
        whole = SquareCatcher(exponent, least, len(w) // exponent)
        whole.append(np.array(w, np.int64))
        assert whole.runs() == want, w
        online, i = SquareCatcher(exponent, least), 0
        while i < len(w):
            m = rng.choice([1, 1, 2, 7, 30])
            online.append(np.array(w[i : i + m], np.int64))
            i += m
        assert online.runs() == want, w


def test_long_sequences():
    catcher = SquareCatcher()
    catcher.append(np.zeros(200_000, np.int64))
    assert catcher.runs() == [(0, 200_000, 1)]
    catcher = SquareCatcher()
    catcher.append(np.arange(1000))
    for _ in range(4):
        catcher.append(np.arange(30_000))
    assert catcher.runs() == [(1000, 120_000, 30_000)]


def test_equal_hashes_of_different_words(monkeypatch):
    """Where hashes are of no use, words decide."""
    monkeypatch.setattr(SquareCatcher, "_span", lambda self, at, length: np.zeros(len(at), np.uint64))
    catcher = SquareCatcher(2, 1)
    catcher.append(np.array([1, 2, 3, 3, 4, 5]))
    assert all(run in [(2, 2, 1)] for run in catcher.runs())


def expected(rows, exponent=4, least=6):
    out = []
    for key, text in rows:
        words = re.findall("[^\x20\x09-\x0D]+", text or "")
        runs = brute(words, exponent, least)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        out.append((key, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("group_words", [1, 50, 1 << 19])
def test_documents(documents, group_words):
    rng = random.Random(1)
    rows = [
        (1, "a b c " * 5 + "d"),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, "x x x x x"),
        (6, "x x x x x x"),
        (7, "x\x0bx\tx\nx x\rx y"),
        (None, "é ß " * 9),
        (None, "é ß " * 9),
        (6, "x x x x x x"),
        (8, "a a " * 7),
        (9, " ".join(f"w{i % 700}" for i in range(5000)) + " tail"),
        *((100 + i, " ".join(map(str, sequence(rng)))) for i in range(60)),
    ]
    found = periodic_runs(documents(rows), group_words=group_words).collect()
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text) for r in found]
    assert sorted(got, key=str) == expected(rows)


def test_no_documents(documents):
    assert periodic_runs(documents([])).count() == 0


def test_query_on_null_ids_and_empty_texts(spark, documents, tmp_path):
    rows = [(None, "a " * 9), (3, None), (4, ""), (5, "b")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert got[None].n_runs == 1 and (got[None].start, got[None].length, got[None].period) == (0, 9, 1)
    assert got[None].exponent_milli == 9000
    assert got[3].n_runs == 0 and got[3].start is None and got[3].exponent_milli is None
    assert got[3].runs_sha256 == got[4].collapsed_sha256 == got[5].runs_sha256
