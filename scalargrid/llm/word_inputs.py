"""Learned inputs of words: an embedding of the hashed word, and the mean embedding of its hashed character trigrams."""

from __future__ import annotations

import numpy as np

LETTERS = 24  # code points of a word at most
TRIGRAM = 3
WORD_BITS, GRAM_BITS = 12, 13
SIZE = 6
_MIX = np.uint64(0x9E3779B97F4A7C15)


def codes_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words, with 1 marking both ends, and their lengths."""
    raw = np.array(words, dtype=f"<U{LETTERS}").view(np.uint32).reshape(len(words), LETTERS)
    codes = np.zeros((len(words), LETTERS + 2), np.uint64)
    codes[:, 1:-1] = raw
    length = (raw != 0).sum(axis=1)
    codes[:, 0] = 1
    codes[np.arange(len(words)), length + 1] = 1
    return codes, length


def mixed(codes: np.ndarray, first: int, size: int, tag: int, bits: int) -> np.ndarray:
    """Buckets of the ``size`` code points from column ``first`` on."""
    value = np.full(len(codes), tag, np.uint64)
    for k in range(size):
        value = (value ^ codes[:, first + k]) * _MIX
        value ^= value >> np.uint64(29)
    return (value >> np.uint64(64 - bits)).astype(np.int64)


class WordInputs:
    """``2 * SIZE`` inputs a word; the empty word, which pads windows, has zeros."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 5) -> None:
        random = np.random.default_rng(seed)
        self.weights = weights or {
            k: (0.1 * random.standard_normal((1 << bits, SIZE))).astype(np.float32) for k, bits in (("E", WORD_BITS), ("G", GRAM_BITS))
        }
        self.learn([])

    def learn(self, words: list[str]) -> WordInputs:
        """Number the words that ``vectors`` and ``gradients`` mean."""
        codes, length = codes_of(words)
        width = int(length.max(initial=1))  # a word of n characters has n trigrams, both ends counted
        self.word = mixed(codes, 0, LETTERS + 2, 7, WORD_BITS)
        self.grams = np.stack([mixed(codes, k, TRIGRAM, 3, GRAM_BITS) for k in range(width)], axis=1)
        share = (np.arange(width) < length[:, None]) / np.maximum(1, length)[:, None]
        self.share, self.real = share.astype(np.float32), (length > 0).astype(np.float32)[:, None]
        return self

    def vectors(self, used: np.ndarray | slice = slice(None)) -> np.ndarray:
        grams = np.einsum("ukd,uk->ud", self.weights["G"][self.grams[used]], self.share[used])
        return np.concatenate([self.weights["E"][self.word[used]] * self.real[used], grams], axis=1)

    def gradients(self, used: np.ndarray, own: np.ndarray, to_words: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients from those at every place, ``own`` of which numbers the words of ``used``."""
        of_word = np.zeros((len(used), 2 * SIZE), np.float32)
        np.add.at(of_word, own.ravel(), to_words.reshape(-1, 2 * SIZE))
        g = {k: np.zeros_like(v) for k, v in self.weights.items()}
        np.add.at(g["E"], self.word[used], of_word[:, :SIZE] * self.real[used])
        spread = of_word[:, None, SIZE:] * self.share[used][:, :, None]
        np.add.at(g["G"], self.grams[used].ravel(), spread.reshape(-1, SIZE))
        return g
