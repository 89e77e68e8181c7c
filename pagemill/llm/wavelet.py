"""A wavelet matrix over token ids, as the bytes of one compressed file.

Ids are replaced by their rank among the distinct ids of the shard, so the
number of bit-planes follows the shard's own alphabet. Plane l holds, for the
order that the planes above it produce, bit l of each rank from the top; a zero
moves an element to the front, a one behind all zeros. Planes are cut into
blocks that are compressed one by one; the directory in front of them has the
place of each block and the ones before it, so that a lookup reads one block a
plane.

Layout: b"PMWM1\\n", length of the header as 4 bytes, header (JSON, compressed),
alphabet (uint32 as compressed deltas), document table, blocks. Numbers are little-endian.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import zstandard

MAGIC = b"PMWM1\n"
BLOCK_BITS = 1 << 15
_TABLE_IDS = 1 << 22  # ids below it are ranked by a table


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def encode(ids: np.ndarray, documents: np.ndarray) -> bytes:
    """The file of a shard. documents: int64 rows that go into its table unchanged."""
    if len(ids) and ids.max() < _TABLE_IDS:
        alphabet = np.flatnonzero(np.bincount(ids)).astype(np.uint32)
        rank = np.zeros(int(ids.max()) + 1, np.uint32)
        rank[alphabet] = np.arange(len(alphabet))
        order = rank[ids]
    else:
        alphabet, order = np.unique(ids, return_inverse=True)
    planes = max(1, int(len(alphabet) - 1).bit_length()) if len(alphabet) else 0
    order = order.astype(np.uint32 if planes > 16 else np.uint16)
    blocks, places, ones, zeros, place = [], [], [], [], 0
    compressor = zstandard.ZstdCompressor(level=1)
    for level in range(planes):
        bits = (order & order.dtype.type(1 << (planes - 1 - level))).astype(bool)
        starts = range(0, len(bits), BLOCK_BITS)
        before = np.cumsum([0, *(np.count_nonzero(bits[a : a + BLOCK_BITS]) for a in starts)])
        ones.append(before[:-1].tolist())
        zeros.append(len(bits) - int(before[-1]))
        raw = np.packbits(bits).tobytes()
        for at in range(0, len(raw), BLOCK_BITS // 8):
            piece = raw[at : at + BLOCK_BITS // 8]
            block = compressor.compress(piece)
            # mixed bits do not get smaller: such blocks stay as they are
            block = b"\1" + block if len(block) < len(piece) else b"\0" + piece
            blocks.append(block)
            places.append(place)
            place += len(block)
        order = np.concatenate([np.compress(~bits, order), np.compress(bits, order)])
    letters, table = _packed(np.diff(alphabet, prepend=0).astype("<u4")), _packed(documents)
    header = json.dumps(
        {
            "n": len(ids),
            "planes": planes,
            "zeros": zeros,
            "columns": documents.shape[1] if documents.ndim == 2 else 1,
            "sizes": [len(letters), len(table), place],
            "places": places,
            "ones": ones,
        }
    ).encode()
    header = zstandard.ZstdCompressor(level=1).compress(header)
    size = len(header).to_bytes(4, "little")
    return b"".join([MAGIC, size, header, letters, table, *blocks])


class WaveletFile:
    """Reads a shard; positions count within it."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet file")
        at = len(MAGIC) + 4
        size = int.from_bytes(data[at - 4 : at], "little")
        header = json.loads(zstandard.ZstdDecompressor().decompress(data[at : at + size]))
        at += size
        letters, table, body = header["sizes"]
        if len(data) != at + letters + table + body:
            raise ValueError("the wavelet file is cut off")
        self.n, self._planes, self._zeros = header["n"], header["planes"], header["zeros"]
        self.alphabet = np.cumsum(_unpacked(data[at : at + letters], "<u4")).astype(np.uint32)
        self.documents = _unpacked(data[at + letters : at + letters + table], "<i8").reshape(
            -1, header["columns"]
        )
        self._data, self._body = data, at + letters + table
        self._places, self._ones = [*header["places"], body], header["ones"]
        self._per_plane = -(-self.n // BLOCK_BITS)
        self._block = lru_cache(maxsize=64)(self._read_block)

    def _read_block(self, plane: int, block: int) -> np.ndarray:
        i = plane * self._per_plane + block
        raw = self._data[self._body + self._places[i] : self._body + self._places[i + 1]]
        raw = zstandard.ZstdDecompressor().decompress(raw[1:]) if raw[0] else raw[1:]
        count = min(BLOCK_BITS, self.n - block * BLOCK_BITS)
        return np.unpackbits(np.frombuffer(raw, np.uint8), count=count)

    def _rank(self, plane: int, position: int) -> int:
        """Ones of a plane before a position."""
        block, rest = divmod(position, BLOCK_BITS)
        if block == self._per_plane:
            return self.n - self._zeros[plane]
        return self._ones[plane][block] + int(self._block(plane, block)[:rest].sum())

    def _select(self, plane: int, bit: int, count: int) -> int:
        """Position of the element with `count` equal bits before it."""
        if bit:
            before = np.asarray(self._ones[plane])
        else:
            before = np.arange(self._per_plane) * BLOCK_BITS - np.asarray(self._ones[plane])
        block = int(np.searchsorted(before, count, "right")) - 1
        inside = np.flatnonzero(self._block(plane, block) == bit)
        return block * BLOCK_BITS + int(inside[count - before[block]])

    def access(self, position: int) -> int:
        """The id at a position."""
        if not 0 <= position < self.n:
            raise IndexError(position)
        rank = 0
        for plane in range(self._planes):
            bit = int(self._block(plane, position // BLOCK_BITS)[position % BLOCK_BITS])
            ones = self._rank(plane, position)
            position = self._zeros[plane] + ones if bit else position - ones
            rank = rank << 1 | bit
        return int(self.alphabet[rank])

    def _letter(self, token: int) -> int | None:
        i = int(np.searchsorted(self.alphabet, token))
        return i if i < len(self.alphabet) and self.alphabet[i] == token else None

    def _narrow(self, letter: int, position: int) -> tuple[int, int]:
        first, last = 0, position
        for plane in range(self._planes):
            a, b = self._rank(plane, first), self._rank(plane, last)
            if letter >> (self._planes - 1 - plane) & 1:
                first, last = self._zeros[plane] + a, self._zeros[plane] + b
            else:
                first, last = first - a, last - b
        return first, last

    def count(self, token: int, position: int | None = None) -> int:
        """How often an id occurs before a position (in the whole shard if None)."""
        letter = self._letter(token)
        if letter is None:
            return 0
        first, last = self._narrow(letter, self.n if position is None else position)
        return last - first

    def occurrence(self, token: int, number: int) -> int:
        """The position of an id's occurrence, counted from 0."""
        if not 0 <= number < self.count(token):
            raise IndexError(number)
        letter = self._letter(token)
        position = self._narrow(letter, self.n)[0] + number
        for plane in range(self._planes - 1, -1, -1):
            bit = letter >> (self._planes - 1 - plane) & 1
            count = position - self._zeros[plane] if bit else position
            position = self._select(plane, bit, count)
        return position

    def all(self) -> np.ndarray:
        """Every id: planes are undone from the last to the first."""
        rank = np.zeros(self.n, np.uint32 if self._planes > 16 else np.uint16)
        for plane in range(self._planes - 1, -1, -1):
            blocks = [self._read_block(plane, b) for b in range(self._per_plane)]
            bits = np.concatenate(blocks).view(bool)
            above = np.empty_like(rank)
            above[np.flatnonzero(~bits)] = rank[: self._zeros[plane]]
            ones = rank[self._zeros[plane] :] | rank.dtype.type(1 << (self._planes - 1 - plane))
            above[np.flatnonzero(bits)] = ones
            rank = above
        return self.alphabet[rank] if self.n else np.zeros(0, np.uint32)
