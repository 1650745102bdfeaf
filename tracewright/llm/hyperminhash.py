"""HyperMinHash sketches: one hash per element, buckets of a leading-zero count with mantissa bits.

An element's 64-bit hash picks one of ``k`` buckets by its top bits; the rest is read as a number
whose leading zeros (6 bits) and next ``MANTISSA`` bits make a 16-bit register; a bucket keeps the
register of its smallest number.  Buckets that no element met copy the register of the bucket that a
fixed hash sequence reaches first, so that short texts fill all bands too and two equal sets stay equal.
"""

from __future__ import annotations

import numpy as np

from tracewright.functions.runs import WordHasher, mix64, rolling  # noqa: F401

MANTISSA = 10


def runs(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct 64-bit hashes of all runs of n consecutive words, sorted."""
    return np.unique(rolling(word_hashes, n))


def registers(elements: np.ndarray, k: int) -> np.ndarray:
    """The k registers (uint16) of a non-empty set of 64-bit hashes."""
    bits = int(k).bit_length() - 1
    h = mix64(elements ^ np.uint64(0xA5A5A5A5DEADBEEF))
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    rest = h << np.uint64(bits)
    least = np.full(k, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, bucket, rest)
    filled = np.bincount(bucket, minlength=k) > 0
    # leading zeros by the exponent of a float64; exact as the top 53 bits decide it
    top = np.maximum(least >> np.uint64(11), np.uint64(1)).astype(np.float64)
    zeros = (52 - np.frexp(top)[1] + 1).astype(np.int64)
    mantissa = ((least << np.minimum(zeros + 1, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA)).astype(np.int64)
    register = (((zeros & 63) << MANTISSA) | mantissa).astype(np.uint16)
    empty = np.flatnonzero(~filled)
    attempt = np.uint64(1)
    at = empty.astype(np.uint64)
    while len(empty):
        donor = (mix64(at * np.uint64(0x9E3779B97F4A7C15) + attempt) >> np.uint64(64 - bits)).astype(np.int64)
        good = filled[donor]
        register[empty[good]] = register[donor[good]]
        empty, at = empty[~good], at[~good]
        attempt += np.uint64(1)
    return register


def band_keys(register: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` registers; the band's number is part of the key."""
    bands = register.reshape(-1, rows).astype(np.uint64)
    h = np.arange(1, len(bands) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for r in range(rows):
        h = mix64((h ^ bands[:, r]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r + 1))
    return h.view(np.int64)


def collision_rate(n_a: np.ndarray, n_b: np.ndarray, k: int) -> np.ndarray:
    """Chance that the registers of two unrelated sets of these sizes agree in a bucket.

    With bucket loads a and b the smallest numbers are near exponential; a cell of leading-zero class
    i is 2^-i / 2^MANTISSA wide, so the chance is the sum over i of width * ab/(a+b) * the mass of the
    joint density in the class."""
    a, b = np.maximum(n_a / k, 1.0), np.maximum(n_b / k, 1.0)
    total = np.zeros(len(a))
    for i in range(1, 50):
        width = 2.0**-i / (1 << MANTISSA)
        total += width * a * b / (a + b) * (np.exp(-(a + b) * 2.0**-i) - np.exp(-(a + b) * 2.0 ** (1 - i)))
    return total


def jaccard_estimate(reg_a: np.ndarray, reg_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates; registers as 2-D arrays, a row for each pair."""
    k = reg_a.shape[1]
    agree = (reg_a == reg_b).mean(axis=1)
    c = collision_rate(n_a, n_b, k)
    return np.clip((agree - c) / (1 - c), 0.0, 1.0)
