import re
from collections import Counter

from pagemill.llm.substring import remove_repeats

W = 7


def brute(rows, window):
    words = [re.findall("[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(
        tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1)
    )
    out = []
    for (key, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((key, len(w), len(gone), kept))
    return sorted(out, key=str)


def check(documents, rows, **more):
    found = remove_repeats(documents(rows), W, **more).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found), key=str)
    assert got == brute(rows, W)
    assert all(sum(s.words for s in r.spans) == r.n_removed for r in found)


def test_against_brute_force(documents):
    shared = " ".join(f"s{i}" for i in range(9))
    rows = [
        (1, f"a b {shared} c d e"),
        (2, f"{shared}\tf"),
        (3, f"g h i j {shared} {shared} k"),
        (4, None),
        (5, ""),
        (6, "one two three four five six"),
        (6, "one two three four five six seven"),
        (7, "one two three four five six seven"),
        (None, "x " * 30),
        (8, "é ß " * 3 + "tail"),
        (9, " ".join(f"w{i % 50}" for i in range(3000))),
        (10, " ".join(f"u{i}" for i in range(3000))),
    ]
    check(documents, rows)
    check(documents, rows, chunk_bytes=64)  # each document in a chunk of its own


def test_no_repeats_and_no_rows(documents):
    check(documents, [(1, "a b c d e f g h"), (2, "i j k l m n o p")])
    assert remove_repeats(documents([]), W).count() == 0
