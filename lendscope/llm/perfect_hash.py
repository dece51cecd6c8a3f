"""Minimal perfect hashes of sets of byte strings, with the strings stored for verification.

A key gets its slot from levels of bit arrays: a level holds the keys that met no other key there, the rest go on
to the next one. The slot is the number of bits set before the key's bit, so n keys have the slots 0 to n - 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from lendscope.llm.words import mix, seeds

ROOM = 2  # bits of a level for each key that comes to it
MOST_LEVELS = 64


def packed(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    """Strings that lie one after the other in ``data``."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def bytes_of(keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a large_binary array."""
    offsets = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset : keys.offset + len(keys) + 1]
    data = np.frombuffer(keys.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if keys.buffers()[2] else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def string_hashes(keys: pa.Array, seed: int) -> np.ndarray:
    """A 64-bit hash of each non-empty string."""
    if not len(keys):
        return np.zeros(0, np.uint64)
    offsets, data = bytes_of(keys)
    lengths = np.diff(offsets)
    codes, base = seeds(256, 70_000 + 300 * seed), seeds(1, 69_000 + seed)[0]
    powers = np.full(int(lengths.max()), base, np.uint64)
    powers[0] = 1
    with np.errstate(over="ignore"):
        np.multiply.accumulate(powers, out=powers)
        parts = powers[np.arange(len(data)) - np.repeat(offsets[:-1], lengths)] * codes[data]
        return mix(np.add.reduceat(parts, offsets[:-1]) + lengths.astype(np.uint64) * base)


def _places(first: np.ndarray, second: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(first + second * np.uint64(2 * level + 1)) % np.uint64(bits)).astype(np.int64)


class PerfectHash:
    """Slots of a set of distinct strings. ``find`` gives -1 for a string that is not in the set."""

    def __init__(self, seed: int, levels: list[np.ndarray], keys: pa.Array):
        self.seed, self.levels, self.keys = seed, levels, keys
        self.before = np.concatenate([[0], np.cumsum([int(x.sum()) for x in levels])]).astype(np.int64)
        self.ranks = [np.cumsum(x, dtype=np.int64) - x for x in levels]

    @classmethod
    def build(cls, keys: pa.Array) -> PerfectHash:
        """``keys`` are distinct, non-empty strings (large_binary). Strings that no level parts get other hashes."""
        for seed in range(100):
            first, second = string_hashes(keys, 2 * seed), string_hashes(keys, 2 * seed + 1)
            left, levels, order = np.arange(len(keys)), [], []
            while len(left) and len(levels) < MOST_LEVELS:
                bits = ROOM * len(left)
                place = _places(first[left], second[left], len(levels), bits)
                alone = np.bincount(place, minlength=bits) == 1
                settled = alone[place]
                order.append(left[settled][np.argsort(place[settled])])
                levels.append(alone)
                left = left[~settled]
            if not len(left):
                slots = np.concatenate([np.zeros(0, np.int64), *order])
                return cls(seed, levels, keys.take(pa.array(slots)))
        raise RuntimeError("no seed parts all keys")

    def find(self, keys: pa.Array) -> np.ndarray:
        """The slot of each non-empty string, -1 where the string stored there is another."""
        first, second = string_hashes(keys, 2 * self.seed), string_hashes(keys, 2 * self.seed + 1)
        slots, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            if not len(left):
                break
            place = _places(first[left], second[left], level, len(bits))
            here = bits[place]
            slots[left[here]] = self.before[level] + self.ranks[level][place[here]]
            left = left[~here]
        found = np.flatnonzero(slots >= 0)
        same = self._equal(slots[found], keys, found)
        slots[found[~same]] = -1
        return slots

    def _equal(self, slots: np.ndarray, keys: pa.Array, rows: np.ndarray) -> np.ndarray:
        """Whether the stored strings are the asked ones, byte by byte."""
        import pyarrow.compute as pc

        same = pc.equal(self.keys.take(pa.array(slots)), keys.take(pa.array(rows)))
        return same.to_numpy(zero_copy_only=False).astype(bool)

    def dump(self) -> bytes:
        offsets, data = bytes_of(self.keys)
        head = np.array([self.seed, len(self.keys), len(data), len(self.levels), *(len(x) for x in self.levels)], np.int64)
        return b"".join([head.tobytes(), offsets.tobytes(), data.tobytes(), *(np.packbits(x).tobytes() for x in self.levels)])

    @classmethod
    def load(cls, blob: bytes) -> PerfectHash:
        seed, n, size, depth = np.frombuffer(blob, np.int64, 4).tolist()
        widths = np.frombuffer(blob, np.int64, depth, 32).tolist()
        at = 32 + 8 * depth
        offsets = np.frombuffer(blob, np.int64, n + 1, at)
        at += 8 * (n + 1)
        keys = packed(np.diff(offsets), np.frombuffer(blob, np.uint8, size, at))
        at += size
        levels = []
        for bits in widths:
            width = -(-bits // 8)
            levels.append(np.unpackbits(np.frombuffer(blob, np.uint8, width, at), count=bits).astype(bool))
            at += width
        return cls(seed, levels, keys)
