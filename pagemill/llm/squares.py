"""Squares of a growing word sequence, caught by dyadic blocks and merged into runs.

A square of period q is a stretch of 2q words whose halves are equal. Let b be
the power of two with 2b - 1 <= q <= 4b - 2: the first half then holds a whole
aligned block of b words, and q words later the block comes again. So level b
keeps a catcher for each completed block; every window of b words that the
appended words complete is compared with the two catchers whose distance lies in
the level's range, by prefix hashes. Windows that follow a caught block
in step belong to the same repeat, so each repeat is caught once, at its first
block. It is then extended to the left at once and to the right as words come
in. What ends is the longest stretch with that period: a run, if no smaller
period gives the same stretch. Hashes only find candidates; each run is compared
word by word before it is reported.
"""

from __future__ import annotations

import numpy as np

from pagemill.llm.chunks import mixed

_STEP = 0xC2B2AE3D27D4EB4F  # odd, so that it has an inverse modulo 2^64
_INVERSE = pow(_STEP, -1, 1 << 64)


class _Powers:
    """Powers of the step and of its inverse; grown as needed, shared by all sequences."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def grow(cls, n: int) -> None:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, step in (("up", _STEP), ("down", _INVERSE)):
                factors = np.full(size, step, np.uint64)
                factors[0] = 1
                setattr(cls, name, np.multiply.accumulate(factors))


class _Level:
    def __init__(self) -> None:
        self.next = 0  # first window that was not compared yet
        self.hashes = np.zeros(0, np.uint64)  # of the completed blocks
        self.last = (np.zeros(0, bool), np.zeros(0, bool))  # outcome of the windows before


class SquareCatcher:
    """Runs of at least `exponent` periods (2 or more) and `least` words.

    `append` takes the next words as numbers (equal numbers for equal words);
    how a sequence is cut into calls does not change the result. No run has a period above `longest`.
    """

    def __init__(self, exponent: int = 4, least: int = 6, longest: int | None = None):
        if exponent < 2:
            raise ValueError("a square has two periods")
        self._exponent, self._least, self._longest = exponent, least, longest
        self._n = 0
        self._words = np.zeros(64, np.int64)
        self._sums = np.zeros(65, np.uint64)
        self._levels: list[_Level] = []
        none = np.zeros(0, np.int64)
        self._waiting = [none, none, none]  # block, period, words that must agree: not all there yet
        self._open = [none, none, none]  # start, end, period of stretches that reach the last word
        self._ended: list[np.ndarray] = []

    def append(self, words: np.ndarray) -> None:
        """The next words; levels for which whole blocks have come in advance."""
        self._grow(words)
        self._advance(whole=True)
        self._follow()

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs, by start, then period. The sequence ends here."""
        self._advance(whole=False)
        self._check(*self._waiting, last=True)
        self._ended.append(np.column_stack(self._open))
        return self._distinct(np.concatenate(self._ended))

    def _grow(self, words: np.ndarray) -> None:
        n = self._n + len(words)
        while len(self._words) < n:
            self._words = np.concatenate([self._words, np.zeros_like(self._words)])
            self._sums = np.concatenate([self._sums, np.zeros(len(self._sums) - 1, np.uint64)])
        _Powers.grow(n + 1)
        self._words[self._n : n] = words
        terms = mixed(np.asarray(words, np.uint64) + np.uint64(1)) * _Powers.up[self._n : n]
        self._sums[self._n + 1 : n + 1] = self._sums[self._n] + np.cumsum(terms, dtype=np.uint64)
        self._n = n

    def _span(self, at: np.ndarray | slice, length: np.ndarray | int) -> np.ndarray:
        """Hash of `length` words from each position."""
        return (self._sums[at + length] - self._sums[at]) * _Powers.down[at]

    def _advance(self, whole: bool) -> None:
        level = 0
        while True:
            b = 1 << level
            period = 2 * b - 1
            if self._exponent * period > self._n or (self._longest or period) < period:
                return
            if level == len(self._levels):
                self._levels.append(_Level())
            state = self._levels[level]
            if self._n - b + 1 - state.next >= (b if whole else 1):
                self._catch(state, level, b)
            level += 1

    def _catch(self, state: _Level, level: int, b: int) -> None:
        end = self._n - b + 1
        done = len(state.hashes)
        blocks = np.arange(done, self._n // b) << level
        state.hashes = np.concatenate([state.hashes, self._span(blocks, b)])
        low, high = self._sums[state.next : end], self._sums[state.next + b : end + b]
        windows = (high - low) * _Powers.down[state.next : end]
        nearest = (np.arange(state.next - 2 * b + 1, end - 2 * b + 1)) >> level
        kept = []
        for back, before in enumerate(state.last):
            block = nearest - back
            first = int(np.searchsorted(block, 0))
            hit = np.zeros(len(block), bool)
            hit[first:] = windows[first:] == state.hashes[block[first:]]
            joined = np.concatenate([before, hit])
            # a window b words before that was caught too belongs to the same repeat
            new = hit.copy()
            tail = joined[: max(0, len(joined) - b)]
            if len(tail):
                new[-len(tail) :] &= ~tail[-len(new) :]
            kept.append(joined[-b:])
            at = np.flatnonzero(new)
            blocks = block[at] << level
            periods = state.next + at - blocks
            self._check(blocks, periods, (self._exponent - 1) * periods - b + 1)
        state.last = tuple(kept)
        state.next = end

    def _check(self, block: np.ndarray, period: np.ndarray, must: np.ndarray, last: bool = False) -> None:
        """Caught blocks whose repeat goes on for `must` words are extended; those of which too
        few words are there wait."""
        there = block + period + must <= self._n
        if not last:
            kept = [x[~there] for x in (block, period, must)]
            self._waiting = [np.concatenate(x) for x in zip(self._waiting, kept)]
        block, period, must = block[there], period[there], must[there]
        same = self._span(block, must) == self._span(block + period, must)
        block, period = block[same], period[same]
        if self._longest is not None:
            block, period = block[period <= self._longest], period[period <= self._longest]
        if not len(block):
            return
        left = self._agree(block, period, -1, block)
        right = self._agree(block, period, 1, self._n - block - period)
        self._place(block - left, block + period + right, period)

    def _agree(self, at: np.ndarray, period: np.ndarray, side: int, most: np.ndarray) -> np.ndarray:
        """For how many words (at most `most`) before or from `at` the words a period on are equal."""
        length = np.zeros_like(at)
        step = 1 << max(0, int(most.max()).bit_length())
        while step:
            more = np.minimum(length + step, most)
            start = at - more if side < 0 else at
            same = self._span(start, more) == self._span(start + period, more)
            length = np.where(same, more, length)
            step >>= 1
        return length

    def _place(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        over = end < self._n
        self._ended.append(np.column_stack([start[over], end[over], period[over]]))
        still = [start[~over], end[~over], period[~over]]
        self._open = [np.concatenate(x) for x in zip(self._open, still)]

    def _follow(self) -> None:
        """Stretches that reached the last word go on with the words that came."""
        waiting, self._waiting = self._waiting, [x[:0] for x in self._waiting]
        if len(waiting[0]):
            self._check(*waiting)
        start, end, period = self._open
        if len(start) and (end < self._n).any():
            self._open = [x[:0] for x in self._open]
            more = self._agree(end - period, period, 1, self._n - end)
            self._place(start, end + more, period)

    def _distinct(self, found: np.ndarray) -> list[tuple[int, int, int]]:
        out: dict[tuple[int, int], int] = {}
        for start, end, period in self._long_enough(found).tolist():
            if (start, end) in out:
                continue  # with a smaller period
            w = self._words[start:end]
            same = w[: end - start - period] == w[period:]
            if same.all():
                out[start, end] = period
                continue
            # equal hashes of different words: what really repeats in the stretch
            edges = np.flatnonzero(np.diff(same, prepend=False, append=False))
            parts = [(start + a, start + b + period, period) for a, b in edges.reshape(-1, 2).tolist()]
            for a, b, q in self._long_enough(np.array(parts or [(0, 0, 1)])).tolist():
                out[a, b] = min(q, out.get((a, b), q))
        return sorted(((a, b - a, q) for (a, b), q in out.items()), key=lambda r: (r[0], r[2]))

    def _long_enough(self, found: np.ndarray) -> np.ndarray:
        length = found[:, 1] - found[:, 0]
        found = found[length >= np.maximum(self._least, self._exponent * found[:, 2])]
        return found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
