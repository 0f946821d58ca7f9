"""A minimal perfect hash of 64-bit keys, built level by level, in numpy."""

from __future__ import annotations

import struct

import numpy as np

SEED = np.uint64(0x9E3779B97F4A7C15)


def mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each key for one level."""
    with np.errstate(over="ignore"):
        x = keys + SEED * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct keys get distinct numbers from 0, without gaps; other keys get any number or none (-1).

    A level has about two bits per key that is left. Keys that have a bit to themselves are settled
    there, the others go on to the next level. A key's number is the count of set bits before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits) - bits)
            before += int(bits.sum())
        self.size = before

    @classmethod
    def build(cls, keys: np.ndarray, most_levels: int = 64) -> PerfectHash:
        keys = np.asarray(keys, dtype=np.uint64)
        levels: list[np.ndarray] = []
        while len(keys):
            if len(levels) == most_levels:
                raise ValueError("keys of a perfect hash must be distinct")
            size = 2 * len(keys) + 1
            at = (mix(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits.astype(np.int64))
            keys = keys[~bits[at]]
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys, dtype=np.uint64)
        found = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks)):
            if not len(left):
                break
            at = (mix(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            found[left[hit]] = rank[at[hit]]
            left = left[~hit]
        return found

    def to_bytes(self) -> bytes:
        sizes = [len(bits) for bits in self.levels]
        packed = np.packbits(np.concatenate(self.levels).astype(np.uint8)).tobytes() if sizes else b""
        return struct.pack(f"<I{len(sizes)}Q", len(sizes), *sizes) + packed

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        (count,) = struct.unpack_from("<I", data)
        sizes = struct.unpack_from(f"<{count}Q", data, 4)
        bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=4 + 8 * count)).astype(np.int64)
        ends = np.cumsum(sizes).astype(np.int64) if count else np.zeros(0, dtype=np.int64)
        return cls([bits[e - s : e] for s, e in zip(sizes, ends)])
