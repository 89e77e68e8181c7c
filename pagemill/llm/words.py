"""The words of many texts at once, and a table that numbers words by 128 bits of hash.

Words are what ASCII white space separates. They are hashed where they lie in
the texts' bytes, all in one pass, and looked up in arrays, so that neither a string nor a
dictionary entry is made for a word that was met before.
"""

from __future__ import annotations

import numpy as np

from pagemill.llm.chunks import mixed

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# odd multipliers and random words, from fixed seeds: every task has the same
_BYTES = np.random.default_rng(20_240_607).integers(0, 1 << 64, (2, 256), np.uint64)
_STEPS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class _Powers:
    """Powers of both multipliers and of their inverses, as many as the longest slab so far needs."""

    up: list[np.ndarray] = [np.ones(1, np.uint64)] * 2
    down: list[np.ndarray] = [np.ones(1, np.uint64)] * 2

    @classmethod
    def grow(cls, n: int) -> None:
        if len(cls.up[0]) < n:
            size = 1 << (n - 1).bit_length()
            cls.up = [cls._of(step, size) for step in _STEPS]
            cls.down = [cls._of(pow(step, -1, 1 << 64), size) for step in _STEPS]

    @staticmethod
    def _of(step: int, size: int) -> np.ndarray:
        factors = np.full(size, step, np.uint64)
        factors[0] = 1
        return np.multiply.accumulate(factors)


class Words:
    """Where the words of some texts (bytes) lie, which text has how many, and their hashes."""

    def __init__(self, texts: list[bytes]):
        self._data = b" ".join([b"", *texts, b""])
        data = np.frombuffer(self._data, np.uint8)
        space = _SPACE[data]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.starts, self.ends = edges[0::2], edges[1::2]
        after = np.cumsum([len(t) + 1 for t in texts])  # where each text ends
        self.bounds = np.concatenate([[0], np.searchsorted(self.starts, after)])
        _Powers.grow(len(data) + 1)
        lengths = (self.ends - self.starts).astype(np.uint64)
        self.h1, self.h2 = (self._hashes(data, lengths, c) for c in range(2))

    def _hashes(self, data: np.ndarray, lengths: np.ndarray, copy: int) -> np.ndarray:
        total = np.empty(len(data) + 1, np.uint64)
        total[0] = 0
        np.cumsum(_BYTES[copy][data] * _Powers.up[copy][: len(data)], out=total[1:])
        value = (total[self.ends] - total[self.starts]) * _Powers.down[copy][self.starts]
        return mixed(value + lengths)

    def __len__(self) -> int:
        return len(self.starts)

    def texts(self, numbers: np.ndarray) -> list[str]:
        data = self._data
        spans = zip(self.starts[numbers].tolist(), self.ends[numbers].tolist())
        return [data[a:b].decode() for a, b in spans]


class WordTable:
    """Numbers of words from 0 on, in the order in which they were added."""

    def __init__(self) -> None:
        self._slots = np.full(1 << 12, -1, np.int32)
        self._h1 = np.zeros(1 << 10, np.uint64)
        self._h2 = np.zeros(1 << 10, np.uint64)
        self._n = 0

    def __len__(self) -> int:
        return self._n

    def hashes(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._h1[numbers], self._h2[numbers]

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """The number of each word, -1 where it has none."""
        mask = len(self._slots) - 1
        slot = (h1 & np.uint64(mask)).astype(np.int64)
        number = self._slots[slot]
        same = (self._h1[number] == h1) & (self._h2[number] == h2) & (number >= 0)
        out = np.where(same, number, -1)
        left = np.flatnonzero(~same & (number >= 0))  # another word is there: try the next place
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & mask
            number = self._slots[slot]
            same = (self._h1[number] == h1[left]) & (self._h2[number] == h2[left]) & (number >= 0)
            out[left[same]] = number[same]
            go = ~same & (number >= 0)
            left, slot = left[go], slot[go]
        return out.astype(np.int64)

    def add(self, h1: np.ndarray, h2: np.ndarray) -> None:
        """Words that are not there yet, each once."""
        n = self._n + len(h1)
        while len(self._h1) < n:
            self._h1 = np.concatenate([self._h1, np.zeros_like(self._h1)])
            self._h2 = np.concatenate([self._h2, np.zeros_like(self._h2)])
        self._h1[self._n : n], self._h2[self._n : n] = h1, h2
        first = self._n
        if 3 * n > len(self._slots):
            self._slots = np.full(1 << (4 * n - 1).bit_length(), -1, np.int32)
            first = 0
        self._n = n
        self._place(np.arange(first, n))

    def _place(self, numbers: np.ndarray) -> None:
        mask = len(self._slots) - 1
        slot = (self._h1[numbers] & np.uint64(mask)).astype(np.int64)
        while len(numbers):
            # of the words that want a free place the last one written gets it
            free = np.flatnonzero(self._slots[slot] < 0)
            self._slots[slot[free]] = numbers[free]
            left = self._slots[slot] != numbers
            numbers, slot = numbers[left], (slot[left] + 1) & mask
