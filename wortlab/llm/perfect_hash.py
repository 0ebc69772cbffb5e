"""Minimal perfect hashing of distinct 64-bit keys by levels of bit arrays.

Level k hashes the keys that are left into ``SPREAD`` times as many bits; a key alone on its bit is settled there, the others go on
to the next level.  The index of a key is the number of bits set before its own, over all levels: n keys fill 0 to n - 1.
A key that was not built in may get any index, so callers keep the keys in index order and compare.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
SPREAD, LEVELS = 2, 64


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + U64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(29))) * U64(0xBF58476D1CE4E5B9)
    return x >> U64(32)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return ((_mixed(keys, level) * U64(size)) >> U64(32)).astype(np.int64)


class PerfectHash:
    """``bits``: 64-bit words of all levels; ``before``: bits set before each word; ``sizes``: bits of each level (multiples of 64)."""

    def __init__(self, bits: np.ndarray, sizes: list[int]):
        self.bits, self.sizes = bits, sizes
        counts = np.bitwise_count(bits).astype(np.int64)
        self.before = np.cumsum(counts) - counts
        self.n = int(counts.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """From distinct keys; keys that occur twice raise ValueError."""
        left, parts, sizes = keys.astype(U64), [], []
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("the keys are not distinct")
            size = -(-SPREAD * len(left) // 64) * 64
            at = _place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            sizes.append(size)
            left = left[~alone[at]]
        return cls(np.concatenate(parts) if parts else np.zeros(0, U64), sizes)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; -1 where no level has its bit (such a key was not built in)."""
        out = np.full(len(keys), -1, np.int64)
        open_, left, base = None, keys.astype(U64), 0
        for level, size in enumerate(self.sizes):
            at = _place(left, level, size) + base
            word, bit = self.bits[at >> 6], (at & 63).astype(U64)
            here = (word >> bit) & U64(1) == 1
            found = self.before[at >> 6] + np.bitwise_count(word & ((U64(1) << bit) - U64(1)))
            if open_ is None:
                out[here] = found[here]
                open_ = np.flatnonzero(~here)
                left = left[open_]
            else:
                out[open_[here]] = found[here]
                open_, left = open_[~here], left[~here]
            if not len(left):
                break
            base += size
        return out

    def to_bytes(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], "<u8").tobytes() + self.bits.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> PerfectHash:
        n = int(np.frombuffer(raw, "<u8", 1)[0])
        sizes = np.frombuffer(raw, "<u8", n, 8).astype(np.int64).tolist()
        return cls(np.frombuffer(raw, "<u8", -1, 8 + 8 * n).astype(U64), sizes)
