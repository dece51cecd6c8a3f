"""Words of texts as numpy arrays, a whole Arrow batch at a time.

A word is a maximal run of characters other than space and the control characters 9 to 13. All of
these are single bytes in UTF-8, so everything here works on the bytes of an Arrow string column
and no Python string is made. Words are known by 64-bit hashes of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 2 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, start: int = 1) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(start, start + n, dtype=np.uint64) * _STEP) | np.uint64(1)


_BYTE_CODES = seeds(256, 1000)


class Words(NamedTuple):
    """Words of a run of documents. ``first[i]:first[i + 1]`` are those of document i."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray  # byte range of each word in data
    ends: np.ndarray
    data: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null counts as empty."""
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; a longer text stands alone."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(text))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def split_words(column: pa.Array, lower: bool = False) -> Words:
    """Words of each text of a string column, with hashes; ``lower`` folds A-Z."""
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    edge = np.zeros(len(data) + 1, bool)  # word ends also at the end of a document
    edge[offsets] = True
    inside = ~_IS_SPACE[data]
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), first, starts, ends, data)
    lengths = ends - starts
    packed_first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(int(lengths.sum()), dtype=np.int32 if len(data) < 1 << 31 else np.int64)
    place -= np.repeat(packed_first.astype(place.dtype), lengths)
    powers = np.full(int(lengths.max()), 0x5851F42D4C957F2D, np.uint64)
    powers[0] = 1
    with np.errstate(over="ignore"):
        np.multiply.accumulate(powers, out=powers)
        parts = powers[place]
        del place
        parts *= _BYTE_CODES[data[inside]]
        hashes = mix(np.add.reduceat(parts, packed_first) + lengths.astype(np.uint64) * _STEP)
    return Words(hashes, first, starts, ends, data)


def rolling(hashes: np.ndarray, width: int, start: int = 1) -> np.ndarray:
    """A hash of ``width`` consecutive values from each position that has so many; order counts.

    Runs across the whole array: the caller leaves out positions that cross a document's end.
    ``start`` picks a family of multipliers; two families give independent hashes.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for k, a in enumerate(seeds(width, 50_000 * start)):
            total += hashes[k : k + n] * a
        return mix(total)


def inside_documents(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and position in the word array of every window that lies in one document."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    document = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(document)) - np.repeat(np.cumsum(counts) - counts, counts) + first[:-1][document]
    return document, at
