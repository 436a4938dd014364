"""Binary fuse filters over 64-bit keys: static sets with 16-bit fingerprints (about 18 bits a key).

A key has one slot in each of three consecutive segments; the exclusive or of the three slots is
its fingerprint. Slots are filled in the reverse of a peeling order: keys that are alone in some
slot go first, all such keys of a round at once, until none is left. A seed that leaves a core is
followed by the next one. A key of the set is always found; any other with a chance of 2**-16.
"""

from __future__ import annotations

import math

import numpy as np

SEEDS = 100
_HEAD = np.dtype([("seed", "<u8"), ("segment", "<u4"), ("segments", "<u4")])


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Bijective mixing of 64 bits."""
    with np.errstate(over="ignore"):
        h = keys + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(33)
        h *= np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


def _slots(hashes: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """(3, n) slots: a start by the high 32 bits, and other bits inside the next two segments."""
    high, mask = hashes >> np.uint64(32), np.uint64(segment - 1)
    first = ((high * np.uint64(segments * segment)) >> np.uint64(32)).astype(np.int64)
    second = (first + segment) ^ ((hashes >> np.uint64(18)) & mask).astype(np.int64)
    third = (first + 2 * segment) ^ (hashes & mask).astype(np.int64)
    return np.stack([first, second, third])


def _prints(hashes: np.ndarray) -> np.ndarray:
    return (hashes ^ (hashes >> np.uint64(32))).astype(np.uint16)


def _peeled(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot in which each was alone), None where a core is left."""
    n = slots.shape[1]
    count = np.bincount(slots.ravel(), minlength=size)
    held = np.zeros(size, np.int64)  # exclusive or of the numbers of the keys in a slot
    for row in slots:
        np.bitwise_xor.at(held, row, np.arange(n))
    alone, rounds, left = np.flatnonzero(count == 1), [], n
    while len(alone):
        keys, first = np.unique(held[alone], return_index=True)
        rounds.append((keys, alone[first]))
        left -= len(keys)
        touched = slots[:, keys]
        np.subtract.at(count, touched.ravel(), 1)
        np.bitwise_xor.at(held, touched.ravel(), np.tile(keys, 3))
        touched = np.unique(touched)
        alone = touched[count[touched] == 1]
    return None if left else rounds


def build(keys: np.ndarray) -> bytes:
    """The filter of a set of 64-bit keys (repeated ones count once)."""
    keys = np.unique(keys.astype(np.uint64))
    n = len(keys)
    segment = 1 << max(2, min(18, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    share = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * share / segment) - 2)
    size = (segments + 2) * segment
    for seed in range(SEEDS):
        hashes = _mixed(keys, seed)
        slots = _slots(hashes, segment, segments)
        rounds = _peeled(slots, size)
        if rounds is None:
            continue
        table, prints = np.zeros(size, np.uint16), _prints(hashes)
        for own, place in reversed(rounds):
            three = slots[:, own]
            table[place] = 0
            table[place] = prints[own] ^ table[three[0]] ^ table[three[1]] ^ table[three[2]]
        return np.array([(seed, segment, segments)], _HEAD).tobytes() + table.tobytes()
    raise RuntimeError(f"no seed of {SEEDS} peels {n} keys")


def contains(built: bytes, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the set: all that are, and about one of 65,536 others."""
    head = np.frombuffer(built, _HEAD, 1)[0]
    table = np.frombuffer(built, np.uint16, offset=_HEAD.itemsize)
    hashes = _mixed(keys.astype(np.uint64), int(head["seed"]))
    slots = _slots(hashes, int(head["segment"]), int(head["segments"]))
    return (table[slots[0]] ^ table[slots[1]] ^ table[slots[2]]) == _prints(hashes)
