"""Keyed positions of many documents as compact binary rows.

Billions of (key, document, position) entries would cost several times their size as rows. Here the
entries of a run of documents that go to one partition travel as one row, with each column split
into planes of 16 bits: high planes are mostly zero and vanish in the shuffle's compression.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np


class Entries(NamedTuple):
    """Positions of windows in documents with a key each; ``doc`` and ``version`` name the document."""

    key: np.ndarray
    doc: np.ndarray
    version: np.ndarray
    position: np.ndarray

    def take(self, which: np.ndarray) -> Entries:
        return Entries(*(column[which] for column in self))


def together(parts: list[Entries]) -> Entries:
    return Entries(*(np.concatenate(columns) for columns in zip(*parts, strict=True)))


def planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint16).reshape(len(values), -1).T).tobytes()


def joined(data: memoryview, at: int, n: int, kind) -> tuple[np.ndarray, int]:
    width = np.dtype(kind).itemsize // 2
    planes = np.frombuffer(data, np.uint16, n * width, at).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(kind).reshape(n), at + 2 * n * width


def pack(entries: Entries, key_type) -> bytes:
    """Entries in order of (doc, version, position), documents in runs."""
    n = len(entries.key)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(entries.doc) != 0) | (np.diff(entries.version) != 0)]))
    ids = entries.doc[new]
    steps = np.diff(entries.position.astype(np.uint32), prepend=np.uint32(0))
    return np.array([n, len(new), ids[0]], np.int64).tobytes() + b"".join((
        planes(np.diff(ids, prepend=ids[0])), planes(entries.version[new].astype(np.uint32)),
        planes(np.diff(np.append(new, n)).astype(np.uint32)), planes(steps), planes(entries.key.astype(key_type))))


def unpack(data: bytes, key_type) -> Entries:
    n, docs, base = np.frombuffer(data, np.int64, 3)
    at = 24
    ids, at = joined(data, at, docs, np.int64)
    versions, at = joined(data, at, docs, np.uint32)
    counts, at = joined(data, at, docs, np.uint32)
    steps, at = joined(data, at, n, np.uint32)
    keys, _ = joined(data, at, n, key_type)
    return Entries(keys, np.repeat(base + np.cumsum(ids), counts), np.repeat(versions, counts),
                   np.cumsum(steps, dtype=np.uint32).astype(np.int64))


def dealt(target: np.ndarray, entries: Entries, key_type) -> Iterator[tuple[int, bytes]]:
    """Blobs by target number; entries are in order and stay so."""
    if not len(target):
        return
    order = np.argsort(target.astype(np.uint16) if target.max() < 1 << 16 else target, kind="stable")
    target = target[order]
    cuts = np.append(np.flatnonzero(np.diff(target, prepend=-1)), len(target))
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(target[start]), pack(entries.take(order[start:end]), key_type)
