"""Minimal perfect hashing of distinct 64-bit keys, in parts that tasks build on their own.

A part holds the keys of one value of ``part_of``. Its hash is a cascade of bit arrays: a key whose place in a
level no other key shares owns that bit, the others go on to the next level; a key's number is the
count of bits before its own. So n keys get the numbers 0 to n - 1 and cost some three bits each. The
keys are kept by number beside it, so that a lookup is verified: a key that is not in the part has none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from panelforge.llm.words import mix

_LEVEL_SALT = np.uint64(0x9E3779B97F4A7C15)
_PART_SALT = np.uint64(0xD1B54A32D192ED03)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    return (mix(keys.astype(np.uint64) + _PART_SALT) % np.uint64(parts)).astype(np.int64)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys ^ (np.uint64(level + 1) * _LEVEL_SALT)) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """``sizes``: bits of each level; ``bits``: all levels, one byte a bit; ``before``: set bits before each; ``keys``
    by number."""

    sizes: list[int]
    bits: np.ndarray
    before: np.ndarray
    keys: np.ndarray

    @staticmethod
    def build(keys: np.ndarray) -> PerfectHash:
        """Of distinct keys (signed 64-bit)."""
        left, sizes, levels = keys.astype(np.uint64), [], []
        while len(left):
            size = 2 * len(left)
            at = _place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            sizes.append(size)
            left = left[~alone[at]]
        return PerfectHash.of(sizes, np.concatenate(levels) if levels else np.zeros(0, bool), keys)

    @staticmethod
    def of(sizes: list[int], bits: np.ndarray, keys: np.ndarray) -> PerfectHash:
        hashed = PerfectHash(sizes, bits, (np.cumsum(bits) - bits).astype(np.int32), np.zeros(0, np.int64))
        by = np.empty(len(keys), np.int64)
        by[hashed._number(keys)] = keys
        hashed.keys = by
        return hashed

    def _number(self, keys: np.ndarray) -> np.ndarray:
        wanted = keys.astype(np.uint64)
        number, left, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = start + _place(wanted[left], level, size)
            own = self.bits[at]
            number[left[own]] = self.before[at[own]]
            left = left[~own]
            start += size
        return number

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for those that are not among the keys."""
        number = self._number(keys)
        if len(self.keys):
            number[self.keys[np.maximum(number, 0)] != keys] = -1
        return number

    def __len__(self) -> int:
        return len(self.keys)
