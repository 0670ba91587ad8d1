"""Hashes of words and of runs of words, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

STEP = np.uint64(0x9E3779B97F4A7C15)


def word_hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash per run of `width` words, from the hashes of the words; `width` is part of it."""
    n = max(0, len(words) - width + 1)
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out *= STEP
        out += words[i : i + n]
        out ^= out >> np.uint64(29)
    return out
