"""Wavelet matrix: a sequence of ids as bit-planes with rank and select.

Plane 0 holds the highest bit of every id. After each plane the ids are split stably, those
with bit 0 first. Ones before every 512th position are kept, so that rank needs to count at
most 512 bits. All planes have the same length, so they lie in one byte string.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BLOCK_BITS = 512


@dataclass
class WaveletMatrix:
    length: int
    zeros: np.ndarray  # of each plane
    planes: np.ndarray  # uint8, one row of packed bits per plane
    ranks: np.ndarray  # uint32, ones before each block, one row per plane

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        n = len(ids)
        top = int(ids.max()) if n else 0
        levels = max(1, top.bit_length())
        current = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        width = -(-n // BLOCK_BITS) * BLOCK_BITS // 8
        planes = np.zeros((levels, width), dtype=np.uint8)
        zeros = np.zeros(levels, dtype=np.int64)
        for level in range(levels):
            ones = (current & current.dtype.type(1 << (levels - 1 - level))) != 0
            packed = np.packbits(ones, bitorder="little")
            planes[level, : len(packed)] = packed
            low = np.compress(~ones, current)
            zeros[level] = len(low)
            current = np.concatenate([low, np.compress(ones, current)])
        counts = np.bitwise_count(planes.reshape(levels, -1, BLOCK_BITS // 8)).sum(axis=2, dtype=np.uint32)
        ranks = np.zeros((levels, counts.shape[1] + 1), dtype=np.uint32)
        np.cumsum(counts, axis=1, out=ranks[:, 1:])
        return cls(n, zeros, planes, ranks)

    @property
    def levels(self) -> int:
        return len(self.zeros)

    def to_row(self) -> dict:
        return {
            "n": self.length, "zeros": self.zeros.tolist(),
            "planes": self.planes.tobytes(), "ranks": self.ranks.astype("<u4").tobytes(),
        }

    @classmethod
    def from_row(cls, row: dict) -> WaveletMatrix:
        levels = len(row["zeros"])
        return cls(
            row["n"], np.array(row["zeros"], dtype=np.int64),
            np.frombuffer(row["planes"], dtype=np.uint8).reshape(levels, -1),
            np.frombuffer(row["ranks"], dtype="<u4").reshape(levels, -1),
        )

    def decode(self) -> np.ndarray:
        """All ids in order, by undoing the splits from the lowest plane up."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        current, before = np.zeros((2, self.length), dtype=kind)
        for level in range(self.levels - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.length, bitorder="little").view(bool)
            split = int(self.zeros[level])
            current[split:] |= kind(1 << (self.levels - 1 - level))
            before[np.flatnonzero(~ones)], before[np.flatnonzero(ones)] = current[:split], current[split:]
            current, before = before, current
        return current

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before position ``i``."""
        block, rest = divmod(i, BLOCK_BITS)
        start = block * BLOCK_BITS // 8
        whole = self.planes[level, start : start + rest // 8]
        count = int(self.ranks[level, block]) + int(np.bitwise_count(whole).sum())
        if rest % 8:
            count += (int(self.planes[level, start + rest // 8]) & ((1 << rest % 8) - 1)).bit_count()
        return count

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.length:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            bit = self._bit(level, i)
            ones = self._ones(level, i)
            i = int(self.zeros[level]) + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, symbol: int, i: int) -> tuple[int, int]:
        """Place in the last order where a symbol begins, and where its part before ``i`` ends."""
        start, end = 0, i
        for level in range(self.levels):
            a, b = self._ones(level, start), self._ones(level, end)
            if symbol >> (self.levels - 1 - level) & 1:
                start, end = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                start, end = start - a, end - b
        return start, end

    def rank(self, symbol: int, i: int) -> int:
        """Occurrences of a symbol before position ``i``."""
        if symbol < 0 or symbol >> self.levels:
            return 0
        start, end = self._range(symbol, min(max(i, 0), self.length))
        return end - start

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.length)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) given bit of a plane."""
        blocks = self.ranks[level].astype(np.int64)
        if not bit:
            blocks = np.arange(len(blocks)) * BLOCK_BITS - blocks
        block = int(np.searchsorted(blocks, k, side="right")) - 1
        start = block * BLOCK_BITS // 8
        bits = np.unpackbits(self.planes[level, start : start + BLOCK_BITS // 8], bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(bits == bit)[k - int(blocks[block])])

    def select(self, symbol: int, k: int) -> int:
        """Position of the ``k``-th occurrence (from 0) of a symbol; -1 if there are fewer."""
        if k < 0 or k >= self.count(symbol):
            return -1
        i = self._range(symbol, 0)[0] + k
        for level in range(self.levels - 1, -1, -1):
            bit = symbol >> (self.levels - 1 - level) & 1
            i = self._select_bit(level, bit, i - int(self.zeros[level]) if bit else i)
        return i
