"""Hashed word shingles of texts, computed for a whole batch of texts at once."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark import cloudpickle

CACHE_WORDS = 300_000
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)


def mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x`` (finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept until there are ``most``; then it starts anew."""

    def __init__(self, most: int = CACHE_WORDS):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if it is shorter, but not empty."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total = total * np.uint64(_MULTIPLIERS[0]) + mix(words[k : k + n] * np.uint64(_MULTIPLIERS[1]))
    return mix(total)


def shingle_sets(texts: Sequence[list[bytes]], size: int, hashes: WordHashes) -> list[np.ndarray]:
    """For each list of words, its distinct shingles in ascending order."""
    found = hashes.of([w for words in texts for w in words])
    out, start = [], 0
    for words in texts:
        out.append(np.unique(shingle_hashes(found[start : start + len(words)], size)))
        start += len(words)
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])
