"""A minimal perfect hash over distinct 128-bit keys, with compact arrays beside it.

Level by level, the keys that are left hash into a bit array of twice their
number; those alone at their place set its bit, the others go on. A key's number
is the count of set bits before its own, over all levels: about 5 bits a key,
none of them holding the key. So a key that is not in the set may get a number too, and
a fingerprint beside the counts tells it apart.
"""

from __future__ import annotations

import io

import numpy as np

from pagemill.llm.chunks import mixed

_ROOM = 2  # places for each key of a level
_MOST_LEVELS = 64  # each takes about three fifths of the keys left: enough for any shard


def _places(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)
    h = mixed(a + mixed(b + seed))
    return ((h >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


class PerfectIndex:
    """Numbers of keys (pairs of 64-bit hashes), and for each key a fingerprint, a count and a value."""

    def __init__(self, levels: list[np.ndarray], prints: np.ndarray, counts: np.ndarray, values: np.ndarray):
        self._levels = levels  # set or not, as bytes of 0 and 1
        self._before = [np.cumsum(x, dtype=np.int64) - x for x in levels]
        self._first = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.prints, self.counts, self.values = prints, counts, values

    @classmethod
    def build(
        cls, a: np.ndarray, b: np.ndarray, counts: np.ndarray, values: np.ndarray
    ) -> PerfectIndex:
        """Keys must be distinct."""
        levels, left = [], np.arange(len(a))
        while len(left):
            if len(levels) == _MOST_LEVELS:
                raise ValueError("keys are not distinct")
            size = _ROOM * len(left)
            at = _places(a[left], b[left], len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone.astype(np.uint8))
            left = left[~alone[at]]
        empty = cls(levels, a[:0], counts, values)
        number = empty.numbers(a, b)
        order = np.empty_like(number)
        order[number] = np.arange(len(number))
        return cls(levels, a[order], counts[order], values[order])

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each key; -1 or any number for what is not a key."""
        out = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        for level, bits in enumerate(self._levels):
            at = _places(a[left], b[left], level, len(bits))
            here = bits[at] > 0
            out[left[here]] = self._first[level] + self._before[level][at[here]]
            left = left[~here]
        return out

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(which are keys, their counts, their values)."""
        number = self.numbers(a, b)
        known = number >= 0
        known[known] = self.prints[number[known]] == a[known]
        return known, self.counts[number[known]], self.values[number[known]]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        most = int(self.counts.max(initial=0))
        arrays = {f"level{i}": np.packbits(x) for i, x in enumerate(self._levels)}
        np.savez(
            out,
            sizes=np.array([len(x) for x in self._levels], np.int64),
            prints=self.prints,
            counts=self.counts.astype(np.min_scalar_type(most)),
            values=self.values,
            **arrays,
        )
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectIndex:
        held = np.load(io.BytesIO(data))
        levels = [
            np.unpackbits(held[f"level{i}"], count=int(n)) for i, n in enumerate(held["sizes"])
        ]
        return cls(levels, held["prints"], held["counts"], held["values"])
