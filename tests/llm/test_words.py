import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pagemill.llm.words import Words, WordTable


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=30), max_size=6))
def test_words_of_texts(texts):
    found = Words(texts)
    data = found._data
    cut = [data[a:b] for a, b in zip(found.starts.tolist(), found.ends.tolist())]
    per_text = [cut[a:b] for a, b in zip(found.bounds[:-1], found.bounds[1:])]
    assert per_text == [t.split() for t in texts]


def test_equal_words_have_equal_hashes():
    rng = random.Random(5)
    words = [bytes(rng.choices(b"ab\xc3\xa9", k=rng.randint(1, 12))) for _ in range(5000)]
    found = Words([b" ".join(words[:1000]), b"\t".join(words[1000:])])
    assert len(found) == 5000
    assert len(set(found.h1.tolist())) == len(set(found.h2.tolist())) == len(set(words))
    by_hash = dict(zip(words, found.h1.tolist()))
    assert [by_hash[w] for w in words] == found.h1.tolist()


@pytest.mark.parametrize("bits", [64, 3])
def test_table_against_dictionary(bits):
    """Also with hashes of which only the second differs."""
    rng = np.random.default_rng(bits)
    table, known = WordTable(), {}
    for _ in range(40):
        h1 = rng.integers(0, 1 << min(bits, 62), 300, np.uint64)
        h2 = rng.integers(0, 500, 300, np.uint64)
        keys = list(zip(h1.tolist(), h2.tolist()))
        assert table.find(h1, h2).tolist() == [known.get(k, -1) for k in keys]
        new = list(dict.fromkeys(k for k in keys if k not in known))
        table.add(*(np.array([k[i] for k in new], np.uint64) for i in range(2)))
        known |= {k: len(known) + i for i, k in enumerate(new)}
        assert len(table) == len(known)
        assert table.find(h1, h2).tolist() == [known[k] for k in keys]
