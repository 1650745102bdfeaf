"""Runs of words as 64-bit hashes, for Arrow stages: the JVM's array functions would build every run as text."""

from __future__ import annotations

import numpy as np
import xxhash


def mix64(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on a uint64 array."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


class WordHasher:
    """64-bit hashes of words; keeps those it has met, up to a bound."""

    def __init__(self, most: int = 500_000):
        self.known: dict[str, int] = {}
        self.most = most

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def rolling(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n consecutive words, in order; none for fewer words."""
    if len(word_hashes) < n:
        return np.empty(0, dtype=np.uint64)
    m = len(word_hashes) - n + 1
    h = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + word_hashes[k : k + m] + np.uint64(k + 1))
    return h
