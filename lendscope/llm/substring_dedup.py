"""Passages that repeat an earlier passage word for word, by fixed-block anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.tables import partitions, written
from lendscope.llm.window_blobs import Entries, dealt, together, unpack
from lendscope.llm.words import chunks, inside_documents, rolling, split_words

WINDOW = 20
GATHERED = 1_000_000  # windows that a task compares among themselves before it sends any
PART_BYTES = 16 << 20  # text behind one partition of window keys
BUCKET_BYTES = 3 << 20  # text of one bucket of documents
NULL_ID = -(1 << 63)

SLICES = 4  # a partition's keys are compared in so many steps

_ROUTED = "part long, bucket long, blob binary"


def _bucket(doc: np.ndarray, buckets: int) -> np.ndarray:
    """The documents' bucket; the expression in ``_with_bucket`` says the same."""
    return np.mod(doc, buckets)


def _with_bucket(documents: DataFrame, buckets: int) -> DataFrame:
    doc = F.coalesce(F.col("doc_id"), F.lit(NULL_ID)).cast("long")
    return documents.select("doc_id", "text", doc.alias("doc"), F.xxhash64("text").alias("version")).withColumn(
        "bucket", F.pmod("doc", F.lit(buckets)))


def _windows(batch: pa.RecordBatch, width: int, families: tuple[int, ...]):
    """Words of a batch; document, position in it, and hashes of every window of ``width`` words."""
    words = split_words(batch.column("text"))
    document, at = inside_documents(words.first, width)
    hashes = [rolling(words.hashes, width, start=f)[at] for f in families]
    return words, document, at - words.first[document], hashes


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("doc").to_numpy(), batch.column("version").to_numpy().view(np.uint64).astype(np.uint32)


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted columns: number of each row's run of equal values, and the runs' starts."""
    changed = np.zeros(len(columns[0]), bool)
    changed[:1] = True
    for c in columns:
        changed[1:] |= c[1:] != c[:-1]
    return np.cumsum(changed) - 1, np.flatnonzero(changed)


def _routed(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    part, bucket, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(bucket, pa.int64()), pa.array(blob, pa.binary())],
                                      names=["part", "bucket", "blob"])


def _send(keys: Entries, to: np.ndarray, local: Entries, buckets: int, parts: int, key_type) -> pa.RecordBatch:
    """Rows for the partitions of keys (bucket -1), and rows that only pass through to buckets of documents."""
    rows = [(part, -1, blob) for part, blob in dealt(to, keys, key_type)]
    rows += [(bucket % parts, bucket, blob) for bucket, blob in dealt(_bucket(local.doc, buckets), local, np.uint16)]
    return _routed(rows)


def _probe(block: int, parts: int, buckets: int):
    """Every rolling window of ``block`` words; a window at a multiple of ``block`` is a reference block."""

    def send(gathered: list[tuple]) -> pa.RecordBatch:
        hashes, doc, version, position = (np.concatenate(c) for c in zip(*gathered, strict=True))
        order = np.argsort(hashes, kind="stable")
        run, starts = _runs(hashes[order])
        repeated = np.zeros(len(hashes), bool)
        repeated[order] = np.diff(np.append(starts, len(order)))[run] > 1
        # One window and one reference block of each content go on; more would tell nothing new.
        first = np.zeros(len(hashes), bool)
        first[order[starts]] = True
        blocks = order[position[order] % block == 0]
        if len(blocks):
            first[blocks[_runs(hashes[blocks])[1]]] = True
        entries = Entries(hashes.astype(np.uint32), doc, version, position)
        local = np.flatnonzero(repeated)
        sent = np.flatnonzero(first)
        to = ((hashes[sent] >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
        return _send(entries.take(sent), to, entries.take(local)._replace(key=np.zeros(len(local), np.uint16)),
                     buckets, parts, np.uint32)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered, n = [], 0
        for batch in batches:
            for part in chunks(batch, "text"):
                doc, version = _ids(part)
                _, document, position, (hashes,) = _windows(part, block, (1,))
                gathered.append((hashes, doc[document], version[document], position))
                n += len(hashes)
                if n >= GATHERED:
                    yield send(gathered)
                    gathered, n = [], 0
        if n:
            yield send(gathered)

    return probe


def _passing(table: pa.Table) -> tuple[list[tuple[int, int, bytes]], list[bytes]]:
    """Rows that only pass through to a bucket of documents, and the blobs of keys."""
    routed = list(zip(table.column("bucket").to_pylist(), table.column("blob").to_pylist(), strict=True))
    return [(0, bucket, blob) for bucket, blob in routed if bucket >= 0], [blob for bucket, blob in routed if bucket < 0]


def _sliced(blobs: list[bytes], key_type) -> Iterator[Entries]:
    """The entries of all blobs, some ranges of keys at a time."""
    low = 8 * np.dtype(key_type).itemsize - SLICES.bit_length() + 1
    for n in range(SLICES if blobs else 0):
        parts = []
        for blob in blobs:
            entries = unpack(blob, key_type)
            parts.append(entries.take(np.flatnonzero(entries.key >> key_type(low) == n)))
        if sum(len(p.key) for p in parts):
            yield together(parts)


def _hits(block: int, buckets: int):
    """Windows equal to a reference block elsewhere, by bucket of documents."""

    def match(table: pa.Table) -> pa.Table:
        rows, blobs = _passing(table)
        for entries in _sliced(blobs, np.uint32):
            order = np.argsort(entries.key, kind="stable")
            run, starts = _runs(entries.key[order])
            sizes = np.diff(np.append(starts, len(order)))
            has_block = np.add.reduceat((entries.position[order] % block == 0).astype(np.int64), starts) > 0
            hit = np.sort(order[((sizes > 1) & has_block)[run]])
            found = entries.take(hit)._replace(key=np.zeros(len(hit), np.uint16))
            rows += [(0, b, blob) for b, blob in dealt(_bucket(found.doc, buckets), found, np.uint16)]
        return pa.Table.from_batches([_routed(rows)])

    return match


def _places(table: pa.Table, docs: pa.Table, first: np.ndarray) -> np.ndarray:
    """Places in the word array of the entries in the blobs; a document's rows all get its entries."""
    blobs = table.column("blob").to_pylist()
    if not blobs:
        return np.zeros(0, np.int64)
    entries = together([unpack(b, np.uint16) for b in blobs])
    doc, version = docs.column("doc").to_numpy(), docs.column("version").to_numpy().view(np.uint64).astype(np.uint32)
    order = np.lexsort((version, doc))
    names = np.zeros(len(order), [("doc", np.int64), ("version", np.uint32)])
    names["doc"], names["version"] = doc[order], version[order]
    wanted = np.zeros(len(entries.doc), names.dtype)
    wanted["doc"], wanted["version"] = entries.doc, entries.version
    run, starts = _runs(names["doc"], names["version"])
    at = np.searchsorted(names[starts], wanted)
    ends = np.append(starts[1:], len(order))
    copies = (ends - starts)[at]
    row = order[np.repeat(starts[at], copies) + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)]
    return first[row] + np.repeat(entries.position, copies)


def _extend(window: int, block: int, parts: int, buckets: int):
    """Every window of ``window`` words that holds a hit, with a hash for an exact comparison."""

    def extend(key: tuple, docs: pa.Table, hits: pa.Table) -> pa.Table:
        empty = pa.Table.from_batches([_routed([])])
        if not docs.num_rows or not hits.num_rows:
            return empty
        batch = docs.combine_chunks().to_batches()[0]
        words, document, position, (where, what) = _windows(batch, window, (1, 2))
        if not len(document):
            return empty
        hit = np.zeros(len(words.hashes) + 1, np.int64)
        hit[_places(hits, docs, words.first) + 1] = 1
        seen = np.cumsum(hit)
        at = position + words.first[document]
        near = np.flatnonzero(seen[at + window - block + 1] > seen[at])
        doc, version = _ids(batch)
        where, entries = where[near], Entries(what[near], doc[document[near]], version[document[near]], position[near])
        order = np.lexsort((entries.position, entries.doc, entries.key, where))
        run, starts = _runs(where[order], entries.key[order])
        least = order[starts][run]
        later = (entries.doc[order] != entries.doc[least]) | (entries.position[order] != entries.position[least])
        sent, local = np.sort(order[starts]), np.sort(order[later])
        to = ((where[sent] >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
        kept = entries.take(local)._replace(key=np.zeros(len(local), np.uint16))
        return pa.Table.from_batches([_send(entries.take(sent), to, kept, buckets, parts, np.uint64)])

    return extend


def _later(buckets: int):
    """Of equal windows, all but the one that starts first, by bucket of documents."""

    def later(table: pa.Table) -> pa.Table:
        rows, blobs = _passing(table)
        for entries in _sliced(blobs, np.uint64):
            order = np.lexsort((entries.position, entries.doc, entries.key))
            run, starts = _runs(entries.key[order])
            least = order[starts][run]
            again = (entries.doc[order] != entries.doc[least]) | (entries.position[order] != entries.position[least])
            found = entries.take(order[again])
            found = found.take(np.lexsort((found.position, found.version, found.doc)))._replace(
                key=np.zeros(int(again.sum()), np.uint16))
            rows += [(0, b, blob) for b, blob in dealt(_bucket(found.doc, buckets), found, np.uint16)]
        return pa.Table.from_batches([_routed(rows)])

    return later


def _remaining(window: int):
    """Documents without the words that a repeated window covers."""

    def remaining(key: tuple, docs: pa.Table, windows: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "text": pa.array([], pa.string()),
                             "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()),
                             "removed": pa.array([], pa.list_(pa.int32()))})
        batch = docs.combine_chunks().to_batches()[0]
        words = split_words(batch.column("text"))
        n = len(words.hashes)
        change = np.zeros(n + 1, np.int64)
        at = _places(windows, docs, words.first)
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
        covered = np.cumsum(change)[:n] > 0
        removed = np.concatenate([[0], np.cumsum(covered)])[words.first]
        kept = np.flatnonzero(~covered)
        lengths = (words.ends - words.starts)[kept]
        to = np.cumsum(lengths + 1) - lengths - 1
        out = np.full(int((lengths + 1).sum()), 32, np.uint8)
        inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(to, lengths) + inner] = words.data[np.repeat(words.starts[kept], lengths) + inner]
        ends = np.append(to, len(out))
        first = np.searchsorted(kept, words.first)
        texts = [out[ends[a]:max(ends[b] - 1, ends[a])].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        # Ends of maximal runs of removed words, from each document's start: start, end, start, end, ...
        edge = np.zeros(n + 1, bool)
        edge[words.first] = True
        inside = np.concatenate([[False], covered, [False]])
        starts = np.flatnonzero(covered & (~inside[:-2] | edge[:-1]))
        stops = np.flatnonzero(covered & (~inside[2:] | edge[1:])) + 1
        owner = np.searchsorted(words.first, starts, side="right") - 1
        spans = (np.stack([starts, stops], axis=1) - words.first[owner][:, None]).ravel().astype(np.int32)
        offsets = 2 * np.searchsorted(owner, np.arange(batch.num_rows + 1))
        return pa.table({
            "doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.binary()).cast(pa.string()),
            "n_words": np.diff(words.first), "n_removed": np.diff(removed),
            "removed": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(spans))})

    return remaining


def remove_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without words that repeat: (doc_id, text, n_words, n_removed, removed).

    ``documents`` has (doc_id, text). A window is ``window`` consecutive words of one document. It repeats
    if an equal window starts earlier: in a document of smaller doc_id, or before it in the same document.
    All words of repeating windows go, judged on the input; ``removed`` holds their maximal runs as
    start, end, start, end, ... in words. ``text`` is the kept words joined by one space. Null and
    empty texts have no words. A null doc_id comes before all others. Rows that share doc_id have no
    order between them, so equal windows at equal places of such rows do not repeat each other.

    1. Anchors: each window of half the length (the block) is probed against the blocks at multiples
       of that length in all documents. Two equal windows always share such a block, so a window
       without a hit cannot repeat. Probes carry 32 bits beyond their partition; a false hit costs
       a comparison, nothing else.
    2. Extension: windows around hits are compared by 64 bits beyond their partition, and all but the
       first of each content repeat. Overlapping ones merge into maximal runs.

    A task compares what it has among itself first and sends each content once, so a passage that a
    third of all documents hold costs one entry per task, not one per document. Entries travel in
    compact blobs. Texts are shuffled once, into buckets by doc_id that both cogroups reuse.
    """
    block = (window + 1) // 2
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = partitions(spark, size, PART_BYTES)
    buckets = partitions(spark, size, BUCKET_BYTES)
    docs = _with_bucket(documents, buckets)
    probes = docs.select("doc", "version", "text").mapInArrow(_probe(block, parts, buckets), _ROUTED)
    hits = written(probes.groupBy("part").applyInArrow(_hits(block, buckets), _ROUTED).select("bucket", "blob"))
    grouped = docs.groupBy("bucket")
    windows = grouped.cogroup(hits.groupBy("bucket")).applyInArrow(_extend(window, block, parts, buckets), _ROUTED)
    repeats = windows.groupBy("part").applyInArrow(_later(buckets), _ROUTED).select("bucket", "blob")
    return grouped.cogroup(repeats.groupBy("bucket")).applyInArrow(
        _remaining(window), "doc_id long, text string, n_words long, n_removed long, removed array<int>")
