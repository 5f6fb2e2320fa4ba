"""Static three-wise binary fuse filter, built and probed with numpy."""

from __future__ import annotations

import math

import numpy as np

U64 = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """Murmur finaliser on 64-bit keys; its two multipliers are fixed values."""
    with np.errstate(over="ignore"):
        h = keys + U64(seed)
        h ^= h >> U64(33)
        h *= U64(0xFF51AFD7ED558CCD)
        h ^= h >> U64(33)
        h *= U64(0xC4CEB9FE1A85EC53)
        h ^= h >> U64(33)
    return h


def _shape(n: int) -> tuple[int, int]:
    """Segment length and number of segments for n keys; both constants come from the published sizing rule."""
    if n < 2:
        return 4, 3
    segment = 1 << max(2, min(18, int(math.log(n) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    return segment, max(1, -(-int(n * factor) // segment) - 2) + 2


def _slots(h: np.ndarray, segment: int, count: int) -> np.ndarray:
    """Three slots in three neighbouring segments, as an array of shape (3, keys)."""
    first = ((h >> U64(32)) * U64(count - 2)) >> U64(32)
    low = U64(segment - 1)
    at = first * U64(segment)
    return np.stack([at + (h & low), at + U64(segment) + ((h >> U64(18)) & low), at + U64(2 * segment) + ((h >> U64(36)) & low)]).astype(np.int64)


def _print8(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> U64(32))) & U64(255)).astype(np.uint8)


def build(keys: np.ndarray, tries: int = 64) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, one-byte slots) that accept every key and about 1 in 256 others.

    Keys are peeled in rounds: a key with a slot of its own leaves; slots are then filled in
    reverse order of the rounds, so each key sets a slot no later key reads.
    """
    keys = np.unique(keys.astype(U64))
    segment, count = _shape(len(keys))
    for attempt in range(tries):
        if attempt % 8 == 7:
            count += max(1, count // 16)
        seed = (attempt * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1)
        h = _mix(keys, seed)
        slots = _slots(h, segment, count)
        size = segment * count
        degree = np.bincount(slots.ravel(), minlength=size)
        alive = np.ones(len(keys), bool)
        rounds: list[tuple[np.ndarray, np.ndarray]] = []
        while alive.any():
            left = np.flatnonzero(alive)
            single = degree[slots[:, left]] == 1
            has = single.any(axis=0)
            if not has.any():
                break
            peeled = left[has]
            own = slots[single[:, has].argmax(axis=0), peeled]
            rounds.append((peeled, own))
            alive[peeled] = False
            np.subtract.at(degree, slots[:, peeled].ravel(), 1)
        if alive.any():
            continue
        table = np.zeros(size, np.uint8)
        marks = _print8(h)
        for peeled, own in reversed(rounds):
            a, b, c = slots[:, peeled]
            table[own] = 0
            table[own] = marks[peeled] ^ table[a] ^ table[b] ^ table[c]
        return seed, segment, count, table.tobytes()
    raise RuntimeError("no seed peels these keys")


def probe(keys: np.ndarray, seed: int, segment: int, count: int, table: bytes) -> np.ndarray:
    """True where the filter may hold the key; never False for a key that was built in."""
    slots, h = np.frombuffer(table, np.uint8), _mix(keys.astype(U64), seed)
    a, b, c = _slots(h, segment, count)
    return (slots[a] ^ slots[b] ^ slots[c]) == _print8(h)
