"""Sets of word shingles as sorted 64-bit numbers."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over their whole range, one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Hashes of the distinct shingles of the lower-cased (A-Z) words between ASCII white space, sorted.

    With fewer words the whole sequence is one shingle; a text without words has none.
    """
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(hashes))
    total = np.full(len(hashes) - width + 1, np.uint64(width))
    for k in range(width):
        total = (total ^ (total >> _SHIFT)) * _FACTOR + hashes[k : k + len(total)]
    total = mix(total)
    total.sort()
    return total[np.r_[True, total[1:] != total[:-1]]]


def digest(shingles: np.ndarray) -> bytes:
    """Of a whole set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
