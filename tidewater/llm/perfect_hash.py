"""Minimal perfect hashing of 64-bit keys.

Keys that fall alone into their place of a bit array own that place; those that
collide go on to the next, smaller array under another seed, until none is
left.  A key's number is the count of set bits before its own, so n keys get
the numbers 0 to n - 1.  About three bits a key; what is not a key can get a
number too, so callers hold the keys beside it and compare.
"""

from __future__ import annotations

import numpy as np

from .common import mix

GAMMA = 2.0  # places a key in each array
STEP = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level + 1) * int(STEP) & 0xFFFFFFFFFFFFFFFF)
    return (mix(keys + seed) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Bit arrays of 64-bit words, one for each level, and the set bits before
    each word."""

    def __init__(self, words: list[np.ndarray]):
        self.words = words
        flat = np.concatenate(words) if words else np.empty(0, np.uint64)
        bits = np.bitwise_count(flat).astype(np.int64)
        self.before = np.cumsum(bits) - bits
        self.first = np.cumsum([0, *map(len, words)])
        self.flat = flat
        self.n = int(bits.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` (uint64) are distinct."""
        left, words = keys, []
        while len(left):
            size = 64 * max(1, int(np.ceil(GAMMA * len(left) / 64)))
            at = _places(left, len(words), size)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8").astype(np.uint64)
            words.append(bits)
            left = left[~alone[at]]
        return cls(words)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for some that are no keys."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, words in enumerate(self.words):
            if not len(left):
                break
            at = _places(keys[left], level, 64 * len(words))
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            low = word & ((np.uint64(1) << bit) - np.uint64(1))
            number = self.before[self.first[level] + (at >> 6)] + np.bitwise_count(low)
            out[left[hit]] = number[hit]
            left = left[~hit]
        return out

    def dumps(self) -> bytes:
        head = np.array([len(self.words), *map(len, self.words)], dtype="<u8")
        return head.tobytes() + self.flat.astype("<u8").tobytes()

    @classmethod
    def loads(cls, raw: bytes) -> PerfectHash:
        data = np.frombuffer(raw, dtype="<u8").astype(np.uint64)
        levels = int(data[0])
        sizes = data[1:1 + levels].astype(np.int64)
        return cls(np.split(data[1 + levels:], np.cumsum(sizes)[:-1]) if levels else [])
