"""Packing tokenized documents into sequences of fixed length by minimum bin slack."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lendscope.llm.tables import columns, written
from lendscope.llm.words import chunks

CAPACITY = 2048
END_ID = 1
WINDOW = 8_192  # pieces among which sequences are filled
CARRIED = 1_024  # pieces left of a window that the next one takes over
TASK_PIECES = 65_536
SEQUENCES = 1 << 36  # sequence numbers of one task
SPECIAL = {"<|endoftext|>": 50_256}  # the token that the .json vocabulary adds to the ranks


def encoder(path: str, special: dict[str, int] = SPECIAL):
    """``f(text)`` to an array of ids, for a tokenizers (.json) or tiktoken (.tiktoken) vocabulary.

    The string of a special token in a text is that token, as the tokenizers library has it by default. A .json
    file names its special tokens itself; a .tiktoken file does not, so they are given. With none it is ordinary text.
    """
    if path.endswith(".tiktoken"):
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        ranked = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: ranked.encode_to_numpy(text, allowed_special="all")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = not special
    return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def pieces(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """Pieces of documents: (doc_id, start, length, ids_crc32, doc_tokens), with ``ids`` if asked for.

    A document is the ids of its whole text and the end id; it is cut into as many full sequences as it
    holds, and what is left. A null or empty text is its end id alone. ids_crc32 is over
    the piece's ids as little-endian unsigned 32-bit numbers. Rows are taken one by one, so rows that repeat are packed again.
    ``vocabulary`` is a file that every worker has under the same path.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for part in chunks(batch, "text"):
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(ids), capacity):
                        piece = ids[start:start + capacity]
                        row = (doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids))
                        rows.append((*row, piece) if with_ids else row)
                columns = list(zip(*rows, strict=True))
                arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.list_(pa.int32())) for c in columns[5:]]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][:len(arrays)])

    return documents.select("doc_id", "text").mapInArrow(cut, schema)


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths with counts whose sum is as close to ``room`` as it can be without exceeding it.

    Subset sums as bits of a number, longest lengths first. A count is split into 1, 2, 4, ...
    copies; the sums before each such step are kept, and walking back through them tells which were used.
    """
    everything = (1 << room + 1) - 1
    sums, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, copies = min(counts[length], room // length) if length <= room else 0, 1
        while left:
            copies = min(copies, left)
            steps.append((length, copies, sums))
            sums |= sums << length * copies & everything
            left -= copies
            copies *= 2
        if sums >> room & 1:
            break
    at, used = sums.bit_length() - 1, {}
    for length, copies, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + copies
            at -= length * copies
    return used


def fill_sequences(lengths: list[int], capacity: int, stop: int = 0) -> list[list[int]]:
    """Sequences as lists of places in ``lengths``, until no more than ``stop`` places are left.

    Each takes the longest length there is and the lengths that fill the rest best.
    """
    places: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        places.setdefault(lengths[i], []).append(i)
    counts = {n: len(p) for n, p in places.items()}
    left, out = len(lengths), []
    while left > stop:
        longest = max(counts)
        used = {longest: 1}
        counts[longest] -= 1
        if not counts[longest]:
            del counts[longest]
        for length, n in (fill(counts, capacity - longest) if longest < capacity else {}).items():
            used[length] = used.get(length, 0) + n
            counts[length] -= n
            if not counts[length]:
                del counts[length]
        sequence = [places[length].pop() for length, n in used.items() for _ in range(n)]
        left -= len(sequence)
        out.append(sequence)
    return out


def pack(cut: DataFrame, capacity: int = CAPACITY, window: int = WINDOW, carried: int = CARRIED) -> DataFrame:
    """Pieces with sequence_id and offset; columns of those names are replaced, all others pass through.

    ``cut`` has a column ``length`` of 1 to ``capacity``, as made by ``pieces``, and should be a written table.
    Pieces are dealt out evenly over tasks, whatever their keys. A task fills sequences among a window of
    them; the last ``carried`` of a window join the next, so only the end of a task leaves room unused.
    Sequence numbers are unique, not dense: the task's number and a count. Spark sorts rows before it deals them
    evenly, so a task that runs again makes the same sequences.
    """
    spark = cut.sparkSession
    base = cut.select(*columns(cut.columns, "sequence_id", "offset"))
    names = base.columns
    plain = base.toDF(*[f"c{i}" for i in range(len(names))])
    length = f"c{names.index('length')}"

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * SEQUENCES
        waiting: list[pa.RecordBatch] = []

        def emit(stop: int):
            nonlocal number, waiting
            table = pa.Table.from_batches(waiting)
            lengths = table.column(length).to_pylist()
            made = fill_sequences(lengths, capacity, stop)
            order = [i for s in made for i in s]
            at = np.array([lengths[i] for i in order], np.int64)
            sizes = np.array([len(s) for s in made])
            which = np.repeat(np.arange(len(made)), sizes)
            before = np.cumsum(at) - at
            offset = before - before[np.repeat(np.cumsum(sizes) - sizes, sizes)] if len(at) else at
            packed = table.take(pa.array(order, pa.int64())).append_column(
                "sequence_id", pa.array(number + which)).append_column("offset", pa.array(offset))
            number += len(made)
            left = np.setdiff1d(np.arange(len(lengths)), order)
            waiting = table.take(pa.array(left)).combine_chunks().to_batches()
            yield from packed.combine_chunks().to_batches()

        for batch in batches:
            for at in range(0, batch.num_rows, window):
                waiting.append(batch.slice(at, window))
                if sum(b.num_rows for b in waiting) >= window:
                    yield from emit(carried)
        if waiting:
            yield from emit(0)

    schema = T.StructType([*plain.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    tasks = max(1, -(-cut.count() // TASK_PIECES))
    return plain.repartition(tasks).mapInArrow(sequences, schema).toDF(*names, "sequence_id", "offset")


def packed_documents(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """All documents as pieces in sequences: the columns of ``pieces``, sequence_id and offset."""
    return pack(written(pieces(documents, vocabulary, capacity, end_id)), capacity)
