"""Sets of word shingles, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def shingles(text: str, width: int) -> np.ndarray:
    """The distinct hashes, in order, of every ``width`` words in a row; of all words if there are fewer.

    Different shingles share a hash with a chance of 2**-64 per pair.
    """
    found = words(text)
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    n = max(len(found) - width + 1, 1)
    width = min(width, len(found))
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = mixed(out * _FACTOR + hashes[k : k + n])
    return np.unique(out)
