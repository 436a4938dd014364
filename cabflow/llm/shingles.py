"""Sets of hashed word shingles of whole texts, computed over the bytes of a batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from cabflow.llm.common import utf8

# White space between words, [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Offset basis and prime of 64-bit FNV-1a.
FNV_BASIS, FNV_PRIME = np.uint64(0xCBF29CE484222325), np.uint64(0x100000001B3)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits (splitmix64's finish)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """FNV-1a of each byte range, one byte of all ranges at a time, longest ranges first."""
    sizes = ends - starts
    order = np.argsort(-sizes, kind="stable")
    at = starts[order]
    lengths = sizes[order]
    h = np.full(len(order), FNV_BASIS, np.uint64)
    live = len(order)
    for j in range(int(lengths[0]) if live else 0):
        live = int(np.searchsorted(-lengths[:live], -j, "left"))  # those longer than j
        h[:live] = (h[:live] ^ data[at[:live] + j]) * FNV_PRIME
    out = np.empty_like(h)
    out[order] = h
    return mix(out)


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, word starts, word ends, and each text's offset among the words."""
    data, at = utf8(texts)
    if lower:
        data = LOWER[data]
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    bounds = at[(at > 0) & (at < len(data))]  # texts stand end to end: a word ends with its text
    first[bounds] = inside[bounds]
    last[bounds - 1] = inside[bounds - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return data, starts, ends, np.searchsorted(starts, at)


def shingle_sets(texts: pa.Array, size: int = 5) -> list[np.ndarray]:
    """Each text's distinct hashed shingles, sorted; a text of fewer words is one shingle, one without words none."""
    data, starts, ends, at = words(texts)
    hashes = span_hashes(data, starts, ends)
    weights = mix(np.arange(1, size + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    rows = max(0, len(hashes) - size + 1)
    grams = np.zeros(rows, np.uint64)
    for j in range(size):
        grams += hashes[j : j + rows] * weights[j]
    grams = mix(grams)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        n = b - a
        if n >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif n:
            whole = (hashes[a:b] * weights[:n]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(whole + np.array([n], np.uint64) * _ODD))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
