"""Token ids of texts, word by word.

The tokenizer of these operators drops white space and never joins what white
space separates, so the ids of a text are those of its words in order. Words
repeat far more often than texts: each worker keeps the ids of the words it has
met, by 128 bits of hash (words.py), and passes only new ones to the tokenizers library.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from pagemill.llm.words import Words, WordTable

END_ID = 2  # appended to every document
VOCABULARY = "word_bpe_49k.json"

_KEPT_WORDS = 400_000  # words a worker remembers; beyond it, it drops those met once
_KEPT_IDS = 8_000_000
_SLAB = 1 << 18  # bytes of texts that are looked up together; a longer text is a slab of its own
_TOGETHER = 200  # words encoded in one string; much longer strings fall out of the processor's cache
_LATIN_END = "\u0250"  # below it, lower case is the same letter by letter and word by word
_MARK = "0"  # stands between words that are encoded in one string


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes texts with a vocabulary file whose tokens never span white space."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._by_word = _drops_white_space(path)
        self._mark = int(self._whole([_MARK])[0][0])
        # the same without its normalizer, for words that str.lower() normalizes as well
        self._bare = Tokenizer(self._tokenizer.model)
        self._bare.pre_tokenizer = self._tokenizer.pre_tokenizer
        self._added = [t.content.lower() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._forget()

    def _forget(self) -> None:
        self._table = WordTable()
        self._ids = np.zeros(1 << 16, np.uint32)
        self._begin = np.zeros(1 << 14, np.int64)
        self._met = np.zeros(1 << 14, np.int64)
        self._n_ids = 0

    def _shrink(self) -> None:
        """Keep the words met most often, half of the bound at most."""
        met = self._met[: len(self._table)]
        least = 2
        while np.count_nonzero(met >= least) > _KEPT_WORDS // 2:
            least *= 2
        kept = np.flatnonzero(met >= least)
        hashes = self._table.hashes(kept)
        ids, ends = self._gather(kept)
        self._forget()
        if len(kept) and len(ids) <= _KEPT_IDS // 2:
            self._keep(*hashes, ids, ends)

    def _keep(self, h1: np.ndarray, h2: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        """New words with their ids, one after another, and where each word's end."""
        first = len(self._table)
        self._room(len(ids), len(ends))
        self._ids[self._n_ids : self._n_ids + len(ids)] = ids
        self._begin[first + 1 : first + 1 + len(ends)] = self._n_ids + ends
        self._n_ids += len(ids)
        self._table.add(h1, h2)

    def _room(self, ids: int, words: int) -> None:
        while self._n_ids + ids > len(self._ids):
            self._ids = np.concatenate([self._ids, np.zeros_like(self._ids)])
        while len(self._table) + words + 1 > len(self._begin):
            self._begin = np.concatenate([self._begin, np.zeros_like(self._begin)])
            self._met = np.concatenate([self._met, np.zeros_like(self._met)])

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words one after another, and where each word's end."""
        lengths = self._begin[at + 1] - self._begin[at]
        ends = np.cumsum(lengths)
        source = np.repeat(self._begin[at] - (ends - lengths), lengths)
        source += np.arange(len(source))
        return self._ids[source], ends

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _learn(self, words: Words, new: np.ndarray) -> None:
        texts = words.texts(new)
        # words with the mark are encoded one by one
        order = sorted(range(len(texts)), key=[_MARK in w for w in texts].__getitem__)
        new, texts = new[order], [texts[i] for i in order]
        parts = [self._ids_of_words(texts[i : i + _TOGETHER]) for i in range(0, len(texts), _TOGETHER)]
        flat, lengths = (np.concatenate(x) for x in zip(*parts))
        self._keep(words.h1[new], words.h2[new], flat, np.cumsum(lengths))

    def _ids_of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Their ids one after another, and how many each has."""
        if not any(_MARK in w for w in words):
            ids = self._joined_ids(f" {_MARK} ".join(words))
            marks = np.flatnonzero(ids == self._mark)
            if len(marks) == len(words) - 1:
                lengths = np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1
                return np.delete(ids, marks), lengths
        each = self._whole(words)
        return np.concatenate(each), np.array([len(x) for x in each])

    def _joined_ids(self, text: str) -> np.ndarray:
        lower = text.lower()
        if (
            max(text, default="") < _LATIN_END
            and unicodedata.is_normalized("NFC", text)
            and not any(a in lower for a in self._added)
        ):
            found = self._bare.encode_batch_fast([lower], add_special_tokens=False)
            return np.array(found[0].ids, np.uint32)
        return self._whole([text])[0]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text, the end id last; None counts as empty."""
        end = np.array([END_ID], np.uint32)
        if not self._by_word:
            return [np.concatenate([x, end]) for x in self._whole([t or "" for t in texts])]
        out: list[np.ndarray] = []
        slab, size = [], 0
        for text in texts:
            slab.append((text or "").encode())
            size += len(slab[-1])
            if size >= _SLAB:
                out += self._encode_words(Words(slab), end)
                slab, size = [], 0
        if slab:
            out += self._encode_words(Words(slab), end)
        return out

    def _encode_words(self, words: Words, end: np.ndarray) -> list[np.ndarray]:
        at = self._table.find(words.h1, words.h2)
        while len(missing := np.flatnonzero(at < 0)):
            new = missing[np.unique(words.h1[missing], return_index=True)[1]]
            if len(self._table) + len(new) > _KEPT_WORDS or self._n_ids > _KEPT_IDS:
                if len(self._table):
                    self._shrink()
                    at = self._table.find(words.h1, words.h2)
                    if len(self._table) + len(new) <= _KEPT_WORDS:
                        continue
                    self._forget()  # more new words at once than it keeps
                    at[:] = -1
                    continue
            self._learn(words, new)
            at[missing] = self._table.find(words.h1[missing], words.h2[missing])
        self._met[: len(self._table)] += np.bincount(at, minlength=len(self._table))
        ids, ends = self._gather(at)
        bounds = np.concatenate([[0], ends])[words.bounds].tolist()
        return [np.concatenate([ids[a:b], end]) for a, b in zip(bounds[:-1], bounds[1:])]


def _drops_white_space(path: str) -> bool:
    """Whether the vocabulary's pieces never contain white space, nor depend on it, and texts are
    only composed, freed of white space and lower-cased before."""
    with open(path, encoding="utf-8") as file:
        description = json.load(file)
    steps = (description.get("pre_tokenizer") or {}).get("pretokenizers") or []
    normalizers = (description.get("normalizer") or {}).get("normalizers") or []
    if [n["type"] for n in normalizers] != ["NFC", "Replace", "Lowercase"]:
        return False
    return any(
        s.get("type") == "Split"
        and s.get("behavior") == "Removed"
        and s.get("invert")
        and s["pattern"].get("Regex", "").endswith(r"|[^\s\p{L}\p{N}]+")
        for s in steps
    ) and not any(
        a["lstrip"] or a["rstrip"] or a["single_word"] or any(c.isspace() for c in a["content"])
        for a in description.get("added_tokens", [])
    )


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The encoder of this worker process."""
    return WordEncoder(path)


def encoded_rows(
    batches: Iterator[pa.RecordBatch], path: str, at_once: int = 256
) -> Iterator[tuple[int | None, np.ndarray]]:
    """(first column, ids of the second) of each row; a few rows of a batch are encoded at a time."""
    for batch in batches:
        for at in range(0, len(batch), at_once):
            part = batch.slice(at, at_once)
            yield from zip(part.column(0).to_pylist(), encoder(path).encode(part.column(1).to_pylist()))


def crc32(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def _times(matrix: np.ndarray, vector: int) -> int:
    rows = matrix[[i for i in range(32) if vector >> i & 1]]
    return int(np.bitwise_xor.reduce(rows)) if len(rows) else 0


@lru_cache(maxsize=1)
def _byte_shifts() -> list[np.ndarray]:
    """Column images of the CRC register after 1, 2, 4, ... zero bytes."""
    bit = np.array([0xEDB88320] + [1 << i for i in range(31)], np.uint32)
    matrix = bit
    shifts = []
    for doubling in range(3 + 50):
        matrix = np.array([_times(matrix, int(c)) for c in matrix], np.uint32)
        if doubling >= 2:  # one bit squared three times: eight bits
            shifts.append(matrix)
    return shifts


def shifted_crc32(crc: int, following: int) -> int:
    """What a part with `crc` adds, by exclusive or, to the CRC-32 of a whole in
    which `following` bytes come after it."""
    level = 0
    while following:
        if following & 1:
            crc = _times(_byte_shifts()[level], crc)
        following >>= 1
        level += 1
    return crc
