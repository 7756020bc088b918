"""Binary Golay code of length 23: every word is within 3 bits of exactly one of 4,096 codewords."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

_GENERATOR = 0xC75  # fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
LENGTH = 23


def _syndrome(word: int) -> int:
    for shift in range(LENGTH - 1, 10, -1):
        if word >> shift & 1:
            word ^= _GENERATOR << (shift - 11)
    return word


@lru_cache(maxsize=1)
def _cosets() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error of at most 3 bits, and the five of 4 bits (0 if there are none)."""
    bits = [_syndrome(1 << i) for i in range(LENGTH)]
    leaders, fours, seen = np.zeros(2048, np.uint32), np.zeros((2048, 5), np.uint32), np.zeros(2048, int)
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            syndrome, error = 0, 0
            for i in places:
                syndrome ^= bits[i]
                error |= 1 << i
            if weight <= 3:
                leaders[syndrome] = error
            else:
                fours[syndrome, seen[syndrome]] = error
                seen[syndrome] += 1
    return leaders, fours


@lru_cache(maxsize=4)
def codeword_keys(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For every value of ``bits`` bits: index of its nearest codeword; indices of those 4 bits away, or -1."""
    leaders, fours = _cosets()
    values = np.arange(1 << bits, dtype=np.uint32)
    syndrome = np.array([0], dtype=np.uint32)
    for i in range(bits):
        syndrome = np.concatenate([syndrome, syndrome ^ np.uint32(_syndrome(1 << i))])
    near = (values ^ leaders[syndrome]) >> 11
    far = fours[syndrome]
    away = np.where(far > 0, ((values[:, None] ^ far) >> 11).astype(np.int32), -1)
    return near.astype(np.int32), away.astype(np.int32)


@lru_cache(maxsize=1)
def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and of the high 11 bits."""
    tables = []
    for start, bits in ((0, 12), (12, 11)):
        table = np.array([0], dtype=np.uint32)
        for i in range(bits):
            table = np.concatenate([table, table ^ np.uint32(_syndrome(1 << start + i))])
        tables.append(table)
    return tables[0], tables[1]


def nearest(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For words of 23 bits: index of the nearest codeword; indices of those 4 bits away, or -1."""
    leaders, fours = _cosets()
    low, high = _syndromes()
    syndrome = low[values & 4095] ^ high[values >> 12]
    near = (values ^ leaders[syndrome]) >> 11
    far = fours[syndrome]
    return near.astype(np.int32), np.where(far > 0, ((values[:, None] ^ far) >> 11).astype(np.int32), -1)
