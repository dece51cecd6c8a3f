"""Counts of 64-bit keys over a corpus, summed in tasks before they are sent."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lendscope.llm.window_blobs import joined, planes
from lendscope.llm.words import chunks, mix

GATHERED = 2_000_000


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their total."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(keys) else counts


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as steps, and counts, in planes that compress well."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype(np.uint64)
    return np.int64(len(keys)).tobytes() + planes(steps) + planes(counts.astype(np.int64))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    steps, at = joined(data, 8, n, np.uint64)
    counts, _ = joined(data, at, n, np.int64)
    return np.cumsum(steps, dtype=np.uint64), counts


def key_counts(texts: DataFrame, keys: Callable[[pa.Array], np.ndarray], parts: int, least: int = 1) -> DataFrame:
    """(key, count) of every key with ``least`` occurrences or more that ``keys`` makes of the column ``text``.

    A task sums about two million keys before it sends them; what it sends grows with the corpus, but a
    key that is everywhere costs one entry per such run, and keys are dealt evenly by hash.
    """

    def send(gathered: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = summed(np.concatenate(gathered))
        part = (mix(found) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(part[order], prepend=-1)), len(order))
        rows = [(int(part[order[a]]), _packed(found[order[a:b]], counts[order[a:b]]))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                                          names=["part", "blob"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0
        for batch in batches:
            for part in chunks(batch, "text"):
                gathered.append(keys(part.column("text")))
                n += len(gathered[-1])
                if n >= GATHERED:
                    yield send(gathered)
                    gathered, n = [], 0
        if n:
            yield send(gathered)

    def total(table: pa.Table) -> pa.Table:
        found, counts = summed(*(np.concatenate(c) for c in zip(*map(_unpacked, table.column("blob").to_pylist()), strict=True)))
        enough = counts >= least
        return pa.table({"key": found[enough].view(np.int64), "count": counts[enough]})

    return texts.select("text").mapInArrow(count, "part long, blob binary").groupBy("part").applyInArrow(
        total, "key long, count long")
