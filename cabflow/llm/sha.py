"""SHA-256 with states that can be stored: many messages at once, one 64-byte block at a time.

``hashlib`` can copy the state of an unfinished hash, but not write it to a table. A digest in
hex fills exactly one block, so a hash over digests has, before each of them, a state of eight
32-bit words and nothing else. States are arrays of shape (8, messages).
"""

from __future__ import annotations

import math

import numpy as np


def _primes(n: int) -> list[int]:
    found: list[int] = []
    number = 2
    while len(found) < n:
        if all(number % p for p in found):
            found.append(number)
        number += 1
    return found


def _cube_root(v: int) -> int:
    r = round(v ** (1 / 3))
    while r**3 > v:
        r -= 1
    while (r + 1) ** 3 <= v:
        r += 1
    return r


# The standard's constants by its rule: the first 32 bits of the fractions of roots of primes.
ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], np.uint32)
START = np.array([math.isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint16)


def start(n: int) -> np.ndarray:
    return np.repeat(START[:, None], n, 1)


def _turned(x: np.ndarray, *by: int) -> np.ndarray:
    """Exclusive or of ``x`` turned right by each number of bits."""
    out = (x >> np.uint32(by[0])) | (x << np.uint32(32 - by[0]))
    for b in by[1:]:
        out ^= (x >> np.uint32(b)) | (x << np.uint32(32 - b))
    return out


def absorb(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """The states after one more block of 16 words each (16, messages)."""
    w = list(block)
    a, b, c, d, e, f, g, h = state
    for i in range(64):
        if i >= 16:
            x, y = w[i - 15], w[i - 2]
            w.append(w[i - 16] + (_turned(x, 7, 18) ^ (x >> np.uint32(3))) + w[i - 7] + (_turned(y, 17, 19) ^ (y >> np.uint32(10))))
        first = h + _turned(e, 6, 11, 25) + (g ^ (e & (f ^ g))) + ROUND[i] + w[i]
        second = _turned(a, 2, 13, 22) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = first + second, a, b, c, d + first, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h])


def hex_block(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32 bytes) as the blocks that their hex texts fill."""
    text = HEX[digests].view(np.uint8).reshape(len(digests), 64)
    return np.ascontiguousarray(text).view(">u4").astype(np.uint32).T


def finished(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n, 32 bytes) of messages of so many whole blocks each."""
    last = np.zeros((16, state.shape[1]), np.uint32)
    bits = np.asarray(blocks, np.uint64) * np.uint64(512)
    last[0], last[14], last[15] = np.uint32(1 << 31), bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
    return digests(absorb(state, last))


def digests(state: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(state.T).astype(">u4").view(np.uint8).reshape(-1, 32)


def states(raw: np.ndarray) -> np.ndarray:
    """The states whose bytes are ``raw`` (n, 32): the inverse of ``digests``."""
    return np.ascontiguousarray(raw).view(">u4").astype(np.uint32).T
