"""Token ids, packing, and token files against the tokenizers library and plain loops."""

import gc
import weakref
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pagemill.llm import packing, store, token_files, tokens
from pagemill.llm.wavelet import WaveletFile, encode

TEXTS = [
    "Two words.", None, "", "x" * 5000 + " é Å ΣΑΣ", "it's 10 o'clock now\x1cthen 0 0",
    "<|endoftext|>a b<|startoftext|>", "same", "same", " \t\n\x0b\x0c\r ", "many words " * 3000,
]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokens.vocabulary_path())
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, tokens.END_ID]


def test_ids_are_those_of_whole_texts(plain):
    assert [x.tolist() for x in tokens.WordEncoder(tokens.vocabulary_path()).encode(TEXTS)] == [
        plain(t) for t in TEXTS
    ]


def test_ids_when_words_are_forgotten(plain, monkeypatch):
    monkeypatch.setattr(tokens, "_KEPT_WORDS", 6)
    encoder = tokens.WordEncoder(tokens.vocabulary_path())
    for text in ["a b c a b", "a d e f", "g h a b", "i j k l m n o p q", "a b c"]:
        assert encoder.encode([text])[0].tolist() == plain(text)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    plain = Tokenizer.from_file(tokens.vocabulary_path())
    got = tokens.encoder(tokens.vocabulary_path()).encode([text])[0]
    assert got.tolist()[:-1] == plain.encode(text, add_special_tokens=False).ids


@given(st.binary(max_size=50), st.binary(max_size=50))
def test_crc_of_parts(a, b):
    assert tokens.shifted_crc32(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 90), min_size=1, max_size=40))
def test_packing_fills_every_sequence(lengths):
    pieces = packing.assign(lengths, 32)
    covered = {}
    for d, start, length, sequence, offset in pieces:
        for i in range(length):
            covered.setdefault(("doc", d), []).append(start + i)
            covered.setdefault(("seq", sequence), []).append(offset + i)
    assert {k: sorted(v) for k, v in covered.items() if k[0] == "doc"} == {
        ("doc", d): list(range(n)) for d, n in enumerate(lengths)
    }
    used = [len(v) for k, v in covered.items() if k[0] == "seq"]
    assert all(sorted(v) == list(range(len(v))) for v in covered.values())
    assert all(n == 32 or n & (n - 1) == 0 for n in used)


def test_packing_balances_cost():
    rng = np.random.default_rng(0)
    lengths = rng.integers(10, 3000, 500).tolist()
    cost = {}
    for _, _, length, sequence, _ in packing.assign(lengths):
        cost[sequence] = cost.get(sequence, 0) + packing.piece_cost(length)
    full = [cost[s] for s in range(sum(lengths) // packing.SEQUENCE_TOKENS)]
    assert np.std(full) < 0.15 * np.mean(full)


def test_pack(spark, documents, plain):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "no id")]
    found = packing.pack(documents(rows), group_tokens=4000).collect()
    by_doc = {}
    for r in found:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for key, text in rows:
        ids = plain(text)
        for r in by_doc[key, len(ids)]:
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
    assert sum(r.length for r in found) == sum(len(plain(t)) for _, t in rows)
    assert packing.pack(documents([])).count() == 0


def test_packed_ids_are_let_go():
    ids = [np.arange(n, dtype=np.uint32) for n in (9000, 1, 300)]
    kept = [weakref.ref(x) for x in ids]
    rows, _ = packing._packed([1, 2, 3], ids, packing.SEQUENCE_TOKENS, 0)
    assert sum(len(x) for x in rows.column(7).to_pylist()) == 4 * 9301
    del ids, rows
    gc.collect()
    assert all(x() is None for x in kept)


def test_packed_sequences_hold_their_tokens(spark, documents, plain):
    rows = list(enumerate(TEXTS))
    found = packing.pack(documents(rows), group_tokens=4000).collect()
    docs, sequences = {}, {}
    for r in sorted(found, key=lambda r: r.offset):
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length
        assert len(sequences.setdefault(r.sequence_id, [])) == r.offset
        sequences[r.sequence_id] += ids
        docs.setdefault(r.doc_id, {})[r.start] = ids
    whole = {k: [i for at in sorted(parts) for i in parts[at]] for k, parts in docs.items()}
    assert whole == {k: plain(t) for k, t in rows}


def test_wavelet_lookups():
    ids = np.random.default_rng(3).zipf(1.4, 70_000).astype(np.uint32) % 49_000
    data = encode(ids, np.zeros((1, 4), "<i8"))
    shard = WaveletFile(data)
    assert (shard.all() == ids).all()
    for p in [0, 1, 32_767, 32_768, 65_536, 69_999]:
        token = int(ids[p])
        before = int((ids[:p] == token).sum())
        assert (shard.access(p), shard.count(token, p)) == (token, before)
        assert shard.occurrence(token, before) == p
    assert shard.count(48_999_999) == 0
    with pytest.raises(IndexError):
        shard.occurrence(int(ids[0]), int((ids == ids[0]).sum()))
    with pytest.raises(ValueError):
        WaveletFile(data[:-1])
    one = WaveletFile(encode(np.array([7, 7, 7], np.uint32), np.zeros((1, 4), "<i8")))
    assert one.all().tolist() == [7, 7, 7] and one.occurrence(7, 2) == 2


def test_token_files(spark, documents, plain):
    rows = [(9 - i, t) for i, t in enumerate(TEXTS)] + [(2, TEXTS[7]), (None, "no id")]
    place = store.folder(spark, "test-tokens")
    found = token_files.read_shards(token_files.write_shards(documents(rows), place, shard_tokens=512))
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in found.collect())
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    at, wanted = 0, []
    for key, text in ordered:
        ids = np.array(plain(text), "<u4")
        wanted.append((at, key, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == wanted
    none = token_files.write_shards(documents([]), place)
    assert token_files.read_shards(none).count() == 0
