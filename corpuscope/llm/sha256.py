"""SHA-256 on many messages at once, with states that can be kept, copied and sent (FIPS 180-4).

A digest in hexadecimal is one block of 64 bytes, so a message of such digests is a chain of whole
blocks and its state after each of them is eight words. Arrays have words first: states ``(8, n)``,
blocks ``(16, n)``.
"""

from __future__ import annotations

from functools import cache
from math import isqrt

import numpy as np


def _root_bits(prime: int, cube: bool) -> int:
    """The first 32 bits behind the point of the square or cube root of a prime."""
    if not cube:
        return isqrt(prime << 64) & 0xFFFFFFFF
    low, high = 0, 1 << 40
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if middle**3 <= prime << 96 else (low, middle)
    return low & 0xFFFFFFFF


_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, isqrt(p) + 1))]
ROUNDS = np.array([_root_bits(p, True) for p in _PRIMES], dtype=np.uint32)
START = np.array([_root_bits(p, False) for p in _PRIMES[:8]], dtype=np.uint32)[:, None]
# The four hexadecimal digits of a 16-bit number, as one word of a block.
_HEX = np.array([int.from_bytes(b"%04x" % i, "big") for i in range(1 << 16)], dtype=np.uint32)


def _turned(x: np.ndarray, *by: int) -> np.ndarray:
    """The exclusive or of a word turned right by several distances."""
    out = (x >> by[0]) | (x << (32 - by[0]))
    for n in by[1:]:
        out ^= (x >> n) | (x << (32 - n))
    return out


def schedule(block: np.ndarray) -> list[np.ndarray]:
    """The words added in each round, round constants included."""
    w = list(block)
    for t in range(16, 64):
        early, late = w[t - 15], w[t - 2]
        w.append(w[t - 16] + (_turned(early, 7, 18) ^ (early >> 3)) + w[t - 7] + (_turned(late, 17, 19) ^ (late >> 10)))
    return [word + k for word, k in zip(w, ROUNDS)]


def resumed(state: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """The states after one more block, given by its :func:`schedule`; one state or one block may serve all."""
    a, b, c, d, e, f, g, h = state
    for word in words:
        first = h + _turned(e, 6, 11, 25) + (g ^ (e & (f ^ g))) + word
        second = _turned(a, 2, 13, 22) + ((a & b) | (c & (a | b)))
        h, g, f, e, d, c, b, a = g, f, e, d + first, c, b, a, first + second
    return np.stack(np.broadcast_arrays(a, b, c, d, e, f, g, h)) + state


def after_digests(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The states after one more digest in hexadecimal."""
    block = np.empty((16, digests.shape[1]), dtype=np.uint32)
    block[0::2], block[1::2] = _HEX[digests >> 16], _HEX[digests & 0xFFFF]
    return resumed(state, schedule(block))


@cache
def _ending(blocks: int) -> list[np.ndarray]:
    """The schedule of the last block of a message of so many whole blocks."""
    bits = 512 * blocks
    return schedule(np.array([1 << 31, *[0] * 13, bits >> 32, bits & 0xFFFFFFFF], dtype=np.uint32)[:, None])


def ended(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests of messages of ``blocks[i]`` whole blocks, by their states."""
    out = np.empty((8, len(blocks)), dtype=np.uint32)
    for n in np.unique(blocks).tolist():
        own = blocks == n
        out[:, own] = resumed(state if state.shape[1] == 1 else state[:, own], _ending(n))
    return out


def packed(words: np.ndarray) -> list[bytes]:
    """States or digests as 32 bytes each."""
    data = np.ascontiguousarray(words.T).astype(">u4").tobytes()
    return [data[i : i + 32] for i in range(0, len(data), 32)]


def unpacked(data: bytes) -> np.ndarray:
    """States or digests, 32 bytes after 32 bytes, as an array."""
    return np.frombuffer(data, dtype=">u4").reshape(-1, 8).T.astype(np.uint32)
