"""Hashes of words and of runs of words, for the operators on word windows."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes a worker remembers; when full it starts again.
CACHED_WORDS = 400_000

# Odd multipliers for runs of words, and the constants of a 64-bit finalizer.
STEP = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered."""

    def __init__(self, seed: int = 0):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A finalizer, so that every bit depends on all bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(MIX[0])
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(MIX[1])
    return values ^ (values >> np.uint64(31))


def run_hashes(hashes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` hashes; empty if there are fewer."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.full(count, (salt * STEP + length) % 2**64, np.uint64)
    power = 1
    for i in range(length):
        total += hashes[i : i + count] * np.uint64(power)
        power = power * STEP % 2**64
    return mixed(total)


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space (space and \\t to \\r)."""
    return text.encode("utf-8").split() if text else []
