"""Minimal perfect hash over 64-bit keys: levels of collision-free bits, ranked.

Level by level, the keys left hash into a bit array; a key alone on its bit stays there,
the others go on to the next level. A key's slot is the number of set bits before its own,
so n keys get the slots 0..n-1. Lookups take a constant expected number of probes. Strange
keys may hit a slot too; a stored fingerprint tells them apart.
"""

from __future__ import annotations

import struct

import numpy as np

GAMMA = 2.0
_MAGIC = b"WMPH1\0\0\0"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finaliser (xor-shift, multiply) of the keys under a seed."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 0xF1) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Built from distinct keys; ``slots`` looks many keys up at once."""

    def __init__(self, levels: list[int], bits: np.ndarray):
        self.levels, self.bits = levels, bits
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, levels, parts = np.asarray(keys).astype(np.uint64), [], []
        while len(left):
            size = -(-max(64, int(GAMMA * len(left))) // 64) * 64
            place = (mix(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            parts.append(np.packbits(alone, bitorder="little").view("<u8"))
            levels.append(size)
            left = left[~alone[place]]
        return cls(levels, np.concatenate(parts) if parts else np.zeros(0, "<u8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has it."""
        keys = np.asarray(keys).astype(np.uint64)
        found, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        start = 0
        for level, size in enumerate(self.levels):
            if not len(open_):
                break
            place = (mix(keys[open_], level) % np.uint64(size)).astype(np.int64) + start
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            lower = self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            found[open_[hit]] = (self.before[word] + np.bitwise_count(lower))[hit]
            open_, start = open_[~hit], start + size
        return found

    def to_bytes(self) -> bytes:
        sizes = np.array(self.levels, "<i8").tobytes()
        return _MAGIC + struct.pack("<q", len(self.levels)) + sizes + self.bits.tobytes()

    @classmethod
    def from_bytes(cls, content: bytes) -> PerfectHash:
        if content[:8] != _MAGIC:
            raise ValueError("not a perfect hash")
        (count,) = struct.unpack_from("<q", content, 8)
        levels = np.frombuffer(content, "<i8", count, 16).tolist()
        return cls(levels, np.frombuffer(content, "<u8", offset=16 + 8 * count))
