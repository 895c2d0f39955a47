"""Word shingles of a text as a sorted array of distinct 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9),
        np.uint64(0x27D4EB2F165667C5), np.uint64(0x85EBCA77C2B2AE63)]


def _spread(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """A-Z lower-cased, split at ASCII white space; with fewer words than
    ``size`` the whole sequence is one shingle; no word, no shingle."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    k = min(size, len(words))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out += h[i:i + n] * _MIX[i % len(_MIX)] if i < len(_MIX) else _spread(h[i:i + n] + np.uint64(i))
    return np.unique(_spread(out))
