"""Word shingles and MinHash signatures of whole texts, vectorised over a buffer of texts.

Words are runs of bytes other than \\x20 and \\x09-\\x0D. A shingle is a window
of ``k`` words; a text of 1 to k-1 words is one shingle of all its words, a
text without words has none. Shingles are 64-bit hashes: two different ones of
the same pair of texts agree with a chance of some 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import mix64, slices

_RNG = np.random.default_rng(20231)
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2 ** 64))
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Odd multipliers: x -> a * x mod 2**64 permutes the hashes, its least value is one MinHash.
_MULTIPLIERS = _RNG.integers(1, 2 ** 63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every text)."""
    base, n = int(offsets[0]), int(offsets[-1] - offsets[0])
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    part, cut = raw[base:base + n], np.zeros(n + 1, bool)
    cut[offsets - base] = True
    space = _SPACE[part]
    start = ~space
    start[1:] &= space[:-1] | cut[1:n]
    end = ~space
    end[:-1] &= space[1:] | cut[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[part] * _powers(_BASE, n - 1), out=total[1:])
    h = (total[e] - total[s]) * _powers(_BASE_INV, n)[s]
    counts = np.diff(np.searchsorted(s, offsets - base))
    return mix64(h + (e - s).astype(np.uint64)), counts


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text, in order."""
    for lo, hi in slices(offsets):
        words, counts = word_hashes(raw, offsets[lo:hi + 1])
        first = np.cumsum(counts) - counts
        windows = np.zeros(len(words), np.uint64)
        m = len(words) - k + 1
        if m > 0:
            for j in range(k):
                windows[:m] = windows[:m] * _FOLD + words[j:m + j]
            windows[:m] = mix64(windows[:m])
        for a, n in zip(first, counts):
            if n >= k:
                yield np.unique(windows[a:a + n - k + 1])
            elif n:
                h = np.uint64(n)
                with np.errstate(over="ignore"):
                    for w in words[a:a + n]:
                        h = h * _FOLD + w
                yield mix64(np.array([h], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def minhashes(shingles: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values, cut to 16 bits (uint16)."""
    best = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 2048):
        np.minimum(best, (shingles[lo:lo + 2048, None] * _MULTIPLIERS[:n]).min(0), out=best)
    return (mix64(best) >> np.uint64(48)).astype(np.uint16)
