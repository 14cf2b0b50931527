"""Hashed word shingles of whole texts, as sorted arrays of distinct 64-bit numbers."""

from __future__ import annotations

import numpy as np
import xxhash

from tallyloom.llm.wordcache import shared

_U = np.uint64
MAX_WORDS = 100_000


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash; keeps the words a worker meets up to a limit."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < MAX_WORDS:
            self[word] = value
        return value


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text: A-Z in lower case, cut at ASCII white space."""
    words = text.lower().split()
    return np.fromiter(map(shared(("hashes",), WordHashes).__getitem__, words), _U, len(words))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Distinct shingles of `size` words; a shorter text is one shingle, an empty one has none."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, _U)
    for i in range(size):
        out = mix(out * _U(0x9E3779B97F4A7C15) + words[i : n + i])
    return np.unique(out)


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0
