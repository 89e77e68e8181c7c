"""The pipeline against brute-force versions of its stages, each on its own input."""

import random
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from pagemill.llm import langid, mixing, queries, tokens
from tests.llm.plain_pii import Plain
from tests.llm.test_near_dup import brute, edited
from tests.llm.test_text_operators import plain_naive_bayes, reshared

ENGLISH = "the cat sat on a mat with some dogs and they all went for long walks near old rivers".split()
FRENCH = "le chat est assis sur un tapis avec des chiens et ils vont tous se promener vers la vieille ville".split()


def corpus():
    rng = random.Random(11)
    rows = []

    def add(words, lang, source):
        rows.append((len(rows), " ".join(words), lang, source))

    for i in range(12):
        add(rng.choices(ENGLISH, k=rng.randint(30, 90)), "en", "ab"[i % 2])
        add(rng.choices(FRENCH, k=rng.randint(30, 90)), "fr", "cd"[i % 2])
    base = [f"{rng.choice(ENGLISH)}{i}" for i in range(120)]
    for edits in (0, 0, 1, 2, 3, 30):
        add(edited(base, edits, rng).split(), "en", "a")
    add(rng.choices(FRENCH, k=60), "en", "a")  # a wrong label
    add(rng.choices(ENGLISH, k=60), None, None)
    add([*rng.choices(ENGLISH, k=40), "mail", "bo@mail.example.com", "or", "4111 1111 1111 1111,", "2024-05-17"], "en", "b")
    rows += [(900, None, "en", "a"), (901, "", "fr", "b"), (902, "12 34 !?", "en", "c"), (903, "x", None, "d")]
    rows += [rows[0], (None, " ".join(rng.choices(ENGLISH, k=50)), "en", "hot")]
    rows += [(1000 + i, " ".join(rng.choices(ENGLISH, k=35)) + f" own{i}", "en", "hot") for i in range(15)]
    rows += [(2000, " ".join(f"{rng.choice(ENGLISH)}{rng.randrange(900)}" for _ in range(500)), "en", "b")]
    return rows


def plain(frame):
    return Counter((r.doc_id, r.text, r.lang, r.source) for r in frame.collect())


def identified(rows):
    known = [(t, lang) for _, t, lang, _ in rows if lang is not None and any(map(str.isalpha, t or ""))]
    lettered = [r for r in rows if any(map(str.isalpha, r[1] or ""))]
    out = Counter()
    for r, (lang, score) in zip(lettered, plain_naive_bayes(known, [r[1] for r in lettered], langid.FEATURES)):
        if score >= langid.LEAST_SCORE:
            sure = r[2] is None or score >= langid.SURE_SCORE
            out[r[0], r[1], lang if sure else r[2], r[3]] += 1
    return out


def deduplicated(rows):
    classes = brute([(r[0], r[1]) for r in rows])
    kept = {}
    for r in rows:
        if (r[0], r[0]) in classes:  # a representative; of repeated rows one stays
            kept[r[0], r[1]] = r
    return Counter(kept.values())


@pytest.mark.parametrize("extra", [False, True])
def test_stages(spark, documents, extra):
    stages = dict(corpus_pipeline.STAGES)
    docs = documents(corpus(), extra=extra)
    assert docs.count() == len(corpus())

    one = stages["language ID"](spark, docs, "").cache()
    assert plain(one) == identified(corpus())

    two = stages["MinHash near-dedup"](spark, one, "").cache()
    assert plain(two) == deduplicated(list(plain(one).elements()))

    three = stages["PII"](spark, two, "").cache()
    hide = Plain(queries.pseudonym_key(spark)).text
    assert plain(three) == Counter({(k, hide(t), lang, s): n for (k, t, lang, s), n in plain(two).items()})
    assert all(r.n_chars == len(r.text) for r in three.collect())

    four = stages["mixing"](spark, three, "").cache()
    before, after = plain(three), plain(four)
    assert after.keys() <= before.keys() and all(n <= 2 * before[k] for k, n in after.items())
    sizes, taken, longest = Counter(), Counter(), Counter()
    for (_, text, _, source), n in before.items():
        words = len((text or "").split())
        sizes[source] += n * words
        longest[source] = max(longest[source], words)
    for (_, text, _, source), n in after.items():
        taken[source] += n * len((text or "").split())
    for source, target in reshared(dict(sizes)).items():
        assert abs(taken[source] - target) <= longest[source]
    assert one.columns == two.columns == three.columns == four.columns == docs.columns

    check_packing(stages["packing"](spark, four, "").collect(), after)


def check_packing(pieces, documents):
    """Every id of every copy lies in one piece, and sequences have no gaps."""
    encode = Tokenizer.from_file(tokens.vocabulary_path()).encode
    wanted = Counter()
    for (key, text, *_), n in documents.items():
        ids = [*encode(text or "", add_special_tokens=False).ids, tokens.END_ID]
        wanted[key, len(ids)] += n * len(ids)
        for i, x in enumerate(ids):
            wanted[key, len(ids), i, x] += n
    got, sequences = Counter(), {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length
        got[p.doc_id, p.doc_tokens] += p.length
        for i, x in enumerate(ids):
            got[p.doc_id, p.doc_tokens, p.start + i, x] += 1
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert got == wanted
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096


def test_run_is_its_stages(spark, documents, tmp_path):
    documents(corpus(), extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    check_packing(corpus_pipeline.run(spark, str(tmp_path)).collect(), plain(docs))
