"""64-bit hashes of words and word n-grams in numpy, for operators that compare word sequences."""

from __future__ import annotations

import numpy as np
import xxhash

# Odd constants of a multiplicative mix.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xBF58476D1CE4E5B9)
CACHE_WORDS = 1 << 19


class WordHashes(dict):
    """Word to 64-bit hash, remembered up to a bound and then forgotten."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _FOLD
    return values ^ (values >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of `n` words; empty when there are fewer."""
    count = len(hashes) - n + 1
    if count < 1:
        return np.empty(0, np.uint64)
    total = hashes[:count].copy()
    for i in range(1, n):
        total = mixed(total * _STEP) + hashes[i : i + count]
    return mixed(total)
