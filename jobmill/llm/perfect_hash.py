"""Minimal perfect hashing of 64-bit keys, level by level.

A level is a bit array of ``SPARE`` bits per remaining key. Keys that are alone at their
position set its bit and are done; the others go on to the next level. A key's index is
the number of bits set before its own, over all levels: 0 to n - 1, each once. About four
bits a key are stored. A key that was not in the set gets -1 or any index, so callers
compare the key kept at the index.
"""

from __future__ import annotations

import numpy as np

from .spans import U64, mix

SPARE = 2.0
_STEP = 0x9E3779B97F4A7C15


def _positions(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    step = U64(_STEP * (level + 1) % (1 << 64))
    return (mix(keys + step) % U64(size)).astype(np.int64)


class PerfectHash:
    """Bit arrays of all levels, one after another, with set bits counted per word."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """From distinct keys."""
        sizes, levels, left = [], [], keys
        while len(left):
            size = -(-int(SPARE * len(left)) // 64) * 64
            at = _positions(left, len(sizes), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, np.uint8)
            bits[at[alone]] = 1
            sizes.append(size)
            levels.append(np.packbits(bits, bitorder="little").view(U64))
            left = left[~alone]
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, U64))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of every key, -1 where no level has it."""
        out = np.full(len(keys), -1, np.int64)
        left, first = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = _positions(keys[left], level, size) + first
            word, bit = at >> 6, (at & 63).astype(U64)
            there = (self.words[word] >> bit) & U64(1) == 1
            lower = self.words[word] & ((U64(1) << bit) - U64(1))
            out[left[there]] = (self.before[word] + np.bitwise_count(lower))[there]
            left, first = left[~there], first + size
        return out

    def tobytes(self) -> bytes:
        return np.int64(len(self.sizes)).tobytes() + self.sizes.tobytes() + self.words.tobytes()

    @classmethod
    def frombytes(cls, data: bytes) -> PerfectHash:
        levels = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, levels, 8)
        return cls(sizes, np.frombuffer(data, U64, offset=8 + 8 * levels))
