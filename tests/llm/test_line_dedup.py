import random

import numpy as np
import pytest

from pagemill.llm.line_dedup import remove_shared_lines
from pagemill.llm.perfect_hash import PerfectIndex

SPACE = " \t\n\x0b\x0c\r"
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def expected(rows, min_chars, min_documents):
    def key(line):
        return line.strip(SPACE).translate(UPPER)

    holders = {}
    for i, (doc, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            holders.setdefault(k, []).append(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(k := key(x)) < min_chars
            or len(holders[k]) < min_documents
            or max(holders[k]) == (-1 if doc is None else doc)
        ]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("more", [{}, {"chunk_bytes": 200, "shard_keys": 3}])
def test_against_brute_force(documents, more):
    line = "The same line of a licence, found everywhere"
    rng = random.Random(2)
    pool = [f"line number {i} " + "x" * rng.randint(0, 40) for i in range(30)] + ["é" * 39, "é" * 40, ""]
    rows = [
        (1, None),
        (2, ""),
        (3, f"{line}\nown text"),
        (4, f"  {line.upper()}\t\n\n{line}\nown"),
        (5, f"a\r\n{line}\r\nb"),
        (6, line),
        (7, f"{line}\n{line}\nend"),
        (7, f"{line}\nthe same id"),
        (None, f"{line}\nno id"),
        (None, f"no id\n{line}"),
        (8, "É" * 45 + "\n" + "é" * 45),  # only A-Z change case
        *((9 + i, "é" * 45 + " ") for i in range(4)),
        *((20 + i, "\n".join(rng.choices(pool, k=rng.randint(1, 12)))) for i in range(80)),
        (999, "long " * 50_000 + "\n" + line.lower()),
    ]
    found = remove_shared_lines(documents(rows), **more).collect()
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in found), key=str)
    assert got == expected(rows, 40, 5)


def test_all_ids_null_and_no_documents(documents):
    rows = [(None, "0123456789 " * 5)] * 6
    found = remove_shared_lines(documents(rows)).collect()
    assert [r.n_dropped for r in found] == [0] * 6  # all rows have the largest id
    assert remove_shared_lines(documents([])).count() == 0


def test_other_thresholds(documents):
    rows = [(1, "ab\ncd"), (2, "AB \nef"), (3, "gh")]
    found = remove_shared_lines(documents(rows), min_chars=2, min_documents=2).collect()
    assert {r.doc_id: r.kept_text for r in found} == {1: "cd", 2: "AB \nef", 3: "gh"}


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, 1 << 64, (2, n + 1000), np.uint64)
    a[: n // 2] = a[0]  # one half of the key may be shared
    counts, values = rng.integers(1, 300, n), rng.integers(-(1 << 62), 1 << 62, n)
    index = PerfectIndex.from_bytes(PerfectIndex.build(a[:n], b[:n], counts, values).to_bytes())
    assert sorted(index.numbers(a[:n], b[:n]).tolist()) == list(range(n))
    known, c, v = index.find(a, b)
    assert known.tolist() == [True] * n + [False] * 1000
    assert c.tolist() == counts.tolist() and v.tolist() == values.tolist()
    assert all(len(x) <= 2 * n for x in index._levels)


def test_equal_keys_are_refused():
    same = np.ones(2, np.uint64)
    with pytest.raises(ValueError):
        PerfectIndex.build(same, same, np.ones(2, int), np.ones(2, int))
