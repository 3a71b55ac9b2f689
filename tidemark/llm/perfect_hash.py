"""Minimal perfect hashing of sets of integers, built and looked up as whole-array operations."""

from __future__ import annotations

import numpy as np

from tidemark.llm.words import mix

#: Bits per key of a level; more make fewer levels.
ROOM = 2.0
_WORD = np.uint64(63)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys ^ (np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Sends n distinct keys to the numbers 0 to n - 1, each to its own.

    Level by level, keys that meet no other in a bit vector of twice their number set their bit there;
    the rest go on to the next level. A key's number is the rank of its bit over all levels. About
    four bits a key; a foreign key gets any number or -1, so callers keep the keys to verify.
    """

    def __init__(self, keys: np.ndarray):
        left = np.asarray(keys).astype(np.uint64)
        if len(np.unique(left)) != len(left):
            raise ValueError("keys must be distinct")
        self.size, self.levels, base = len(left), [], 0
        while len(left):
            size = max(64, int(ROOM * len(left)))
            at = _place(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size)[at] == 1
            words = np.zeros(size // 64 + 1, dtype=np.uint64)
            np.bitwise_or.at(words, at[alone] >> 6, np.uint64(1) << (at[alone].astype(np.uint64) & _WORD))
            ones = np.bitwise_count(words).astype(np.int64)
            self.levels.append((size, words, base + np.cumsum(ones) - ones))
            base += int(ones.sum())
            left = left[~alone]

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key."""
        keys = np.asarray(keys).astype(np.uint64)
        found, open_ = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys))
        for level, (size, words, ranks) in enumerate(self.levels):
            at = _place(keys[open_], level, size)
            word, bit = words[at >> 6], at.astype(np.uint64) & _WORD
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            found[open_[hit]] = (ranks[at >> 6] + below)[hit]
            open_ = open_[~hit]
            if not len(open_):
                break
        return found
