"""Static three-wise binary-fuse filters over 64-bit keys: no false negatives, about 2**-16 false positives."""

from __future__ import annotations

import math
import struct

import numpy as np

from voxelmill.llm.text import U, mix

_HEAD = struct.Struct("<QII")


def _places(h: np.ndarray, segment: int, count: int) -> np.ndarray:
    """Three slots in three neighbouring segments for each hash."""
    first = ((h >> U(32)) * U(count * segment)) >> U(32)
    mask = U(segment - 1)
    return np.stack(
        [first, (first + U(segment)) ^ ((h >> U(18)) & mask), (first + U(2 * segment)) ^ (h & mask)]
    ).astype(np.int64)


def _print(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> U(32))) & U(0xFFFF)).astype(np.uint16)


def build(keys: np.ndarray) -> bytes:
    """Serialised filter of the given keys (repeats are allowed, an empty set too)."""
    keys = np.unique(keys.astype(np.int64)).view(U)
    n = len(keys)
    segment = 1 << max(2, min(18, int(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 3)))
    count = max(1, -(-int(n * factor) // segment) - 2)
    for seed in range(1, 200):
        if seed % 20 == 0:
            count += max(1, count // 10)
        h = mix(keys + U(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        at = _places(h, segment, count)
        slots = (count + 2) * segment
        left = np.bincount(at.ravel(), minlength=slots)
        who = np.zeros(slots, np.int64)
        for row in at:
            np.bitwise_xor.at(who, row, np.arange(n))
        rounds, done = [], 0
        single = np.flatnonzero(left == 1)
        while len(single):
            key, pick = np.unique(who[single], return_index=True)
            rounds.append((key, single[pick]))
            done += len(key)
            touched = at[:, key]
            for row in touched:
                np.subtract.at(left, row, 1)
                np.bitwise_xor.at(who, row, key)
            touched = np.unique(touched)
            single = touched[left[touched] == 1]
        if done == n:
            table, prints = np.zeros(slots, np.uint16), _print(h)
            for key, slot in reversed(rounds):
                a, b, c = at[:, key]
                table[slot] = prints[key] ^ table[a] ^ table[b] ^ table[c] ^ table[slot]
            return _HEAD.pack(seed, segment, count) + table.tobytes()
    raise RuntimeError("no seed peels these keys")


def contains(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    seed, segment, count = _HEAD.unpack_from(filter_)
    table = np.frombuffer(filter_, np.uint16, offset=_HEAD.size)
    h = mix(keys.astype(np.int64).view(U) + U(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    a, b, c = _places(h, segment, count)
    return (table[a] ^ table[b] ^ table[c]) == _print(h)
