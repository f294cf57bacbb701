"""Minimal perfect hashing of distinct 64-bit keys by levels of collision-free bits."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = 0xD1B54A32D192ED03
_LEVELS = 200


def _spread(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    h = keys + np.uint64((level + 1) * _STEP & 0xFFFFFFFFFFFFFFFF)
    for shift in (30, 27, 31):
        h = (h ^ (h >> np.uint64(shift))) * _MIX
    return ((h ^ (h >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


class MinimalHash:
    """Numbers ``n`` distinct keys 0..n-1.

    On each level the keys left are hashed onto twice as many bits; those alone on their bit are placed, the others go to the
    next level. A key's number is the count of set bits before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, total = [], 0
        for bits in levels:
            counted = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(counted + (total - 1))
            total += int(counted[-1])
        self.size = total

    @classmethod
    def of(cls, keys: np.ndarray) -> MinimalHash:
        left, levels = keys.view(np.uint64), []
        while len(left):
            if len(levels) == _LEVELS:
                raise ValueError("keys are not distinct")
            size = max(8, (2 * len(left) + 7) // 8 * 8)
            at = _spread(left, len(levels), size)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits)
            left = left[~bits[at]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of ``keys``; any number or -1 for a key that is not one of the set (verify it by the key stored there)."""
        out = np.full(len(keys), -1, np.int64)
        left, wide = np.arange(len(keys)), keys.view(np.uint64)
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            at = _spread(wide[left], level, len(bits))
            here = bits[at]
            out[left[here]] = rank[at[here]]
            left = left[~here]
        return out

    def packed(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], np.int64)
        return sizes.tobytes() + b"".join(np.packbits(b).tobytes() for b in self.levels)

    @classmethod
    def unpacked(cls, data: bytes) -> MinimalHash:
        count = int(np.frombuffer(data, np.int64, 1)[0])
        sizes, at, levels = np.frombuffer(data, np.int64, count, 8).tolist(), 8 * (count + 1), []
        for size in sizes:
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, size // 8, at)).astype(bool))
            at += size // 8
        return cls(levels)


class HashedTable:
    """Values of distinct keys in the order of their minimal perfect hash, the key stored beside each to verify it."""

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        self.hash = MinimalHash.of(keys)
        order = np.empty(len(keys), np.int64)
        order[self.hash.numbers(keys)] = np.arange(len(keys))
        self.keys, self.values = keys[order], [v[order] for v in values]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key and whether it is in the table."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.maximum(self.hash.numbers(keys), 0)
        return at, self.keys[at] == keys
