"""Fingerprints of texts from prefix polynomial hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.tables import partitions, written
from lendscope.llm.words import chunks, mix

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_566_083_941)
SPAN = 8  # code points of a span in the sketch
SKETCH = 64  # spans kept: those of least hash
BLOCK = 1 << 18
PART_BYTES = 8 << 20

_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of each base and of its inverse up to n, kept between calls."""
    global _powers
    if not _powers or len(_powers[0][0]) <= n:
        size = max(1 << 12, 1 << n.bit_length())
        _powers = []
        for prime, base in zip(PRIMES, BASES, strict=True):
            pair = []
            for b in (base, pow(base, -1, prime)):
                table = np.ones(size, np.uint64)
                done = 1
                while done < size:  # doubling: the next powers are those so far times base ** done
                    table[done:2 * done] = table[:done] * np.uint64(pow(b, done, prime)) % np.uint64(prime)
                    done *= 2
                pair.append(table)
            _powers.append(tuple(pair))
    return _powers


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


class PrefixHashes:
    """Hashes of all prefixes of a sequence of code points, for two moduli.

    The hash of a prefix is the sum of (code point + 1) * base ** place. A span's hash is a difference of two
    of them, brought back to place 0, so spans of any texts can be compared in constant time.
    """

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        self.sums = []
        for prime, (power, _) in zip(PRIMES, _tables(self.n), strict=True):
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum((codes + np.uint64(1)) * power[:self.n] % np.uint64(prime), out=sums[1:])
            self.sums.append(sums % np.uint64(prime))

    def spans(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """62-bit hashes of spans."""
        out = np.zeros(len(start), np.uint64)
        for sums, prime, (_, inverse) in zip(self.sums, PRIMES, _tables(self.n), strict=True):
            p = np.uint64(prime)
            out = out << np.uint64(31) | (sums[start + length] + p - sums[start]) % p * inverse[start] % p
        return out

    def span(self, start: int, length: int) -> int:
        out = 0
        for sums, prime, (_, inverse) in zip(self.sums, PRIMES, _tables(self.n), strict=True):
            out = out << 31 | (int(sums[start + length]) - int(sums[start])) % prime * int(inverse[start]) % prime
        return out


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """How many code points from place i of a and place j of b are equal, by binary search."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, middle) == b.span(j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def common_prefix(x: str, y: str) -> int:
    """How many code points two texts begin with in common: blocks of growing size, the first unequal one searched."""
    at, size, most = 0, 1 << 10, min(len(x), len(y))
    while at < most:
        end = min(at + size, most)
        a, b = (PrefixHashes(code_points(t[at:end])) for t in (x, y))
        if a.span(0, a.n) != b.span(0, b.n):
            return at + common_extension(a, 0, b, 0)
        at, size = end, min(2 * size, BLOCK)
    return at


def _marks(n: int) -> list[int]:
    """Prefix lengths that a fingerprint of n code points knows: 1, 2, 3, 4, 6, 8, 12, 16, ... below n."""
    out, step = [1, 2, 3], 4
    while step < n:
        out += [step, step + step // 2]
        step *= 2
    return [m for m in out if m < n]


def fingerprint(text: str) -> str:
    """length - hash of the whole - hashes of some prefixes - sketch, in hexadecimal.

    The sketch is the SKETCH least hashes of the distinct spans of SPAN code points; a shorter text is one
    span, an empty one has none. A long text is hashed block by block: block hashes are shifted and added.
    """
    codes = code_points(text)
    n = len(codes)
    marks = np.array(_marks(n), np.int64)
    whole = [0] * len(PRIMES)
    prefix = np.zeros(len(marks), np.uint64)
    least = np.zeros(0, np.uint64)
    for start in range(0, n, BLOCK):
        size = min(BLOCK, n - start)
        hashes = PrefixHashes(codes[start:start + size + SPAN - 1])
        shift = [pow(base, start, prime) for base, prime in zip(BASES, PRIMES, strict=True)]
        here = (marks >= start) & (marks < start + size)
        sums = hashes.sums[0][marks[here] - start] * np.uint64(shift[0]) % np.uint64(PRIMES[0])
        prefix[here] = (sums + np.uint64(whole[0])) % np.uint64(PRIMES[0])
        whole = [(w + int(s[size]) * k) % p for w, s, k, p in zip(whole, hashes.sums, shift, PRIMES, strict=True)]
        n_spans = max(min(size, n - SPAN + 1 - start), 0)
        found = hashes.spans(np.arange(n_spans), SPAN)
        if n < SPAN:
            found = hashes.spans(np.zeros(1, np.int64), n) + np.uint64(n)
        found = mix(found) >> np.uint64(32)
        if len(found) > 4 * SKETCH:  # equal spans have equal hashes, so the least of a few times as many decide
            cut = np.partition(found, 4 * SKETCH)[4 * SKETCH]
            near = np.unique(found[found <= cut])
            found = near if len(near) >= SKETCH else found
        least = np.unique(np.concatenate([least, found]))[:SKETCH]
    return "-".join((f"{n:x}", "".join(f"{w:08x}" for w in whole), prefix.astype(">u4").tobytes().hex(), least.astype(">u4").tobytes().hex()))


def likeness(x: str, y: str) -> float:
    """Likeness of two texts by their fingerprints, 0 to 1: 1 for equal ones.

    The larger of two shares: spans in common (twice the common ones over both, estimated from the sketches), and the
    common prefix over the longer text (binary search over the prefix hashes in both). A fingerprint knows some prefixes only, so
    that share is rounded down by up to a third; ``common_prefix`` tells it exactly from the texts.
    """
    if x == y:
        return 1.0
    (nx, _, px, sx), (ny, _, py, sy) = x.split("-"), y.split("-")
    nx, ny = int(nx, 16), int(ny, 16)
    low, high = 0, min(len(px), len(py)) // 8
    while low < high:
        middle = (low + high + 1) // 2
        if px[8 * (middle - 1):8 * middle] == py[8 * (middle - 1):8 * middle]:
            low = middle
        else:
            high = middle - 1
    prefix = _marks(min(nx, ny))[low - 1] / max(nx, ny) if low else 0.0
    a, b = ({s[k:k + 8] for k in range(0, len(s), 8)} for s in (sx, sy))
    both = sorted(a | b)[:SKETCH]
    similarity = len(a & b & set(both)) / len(both) if both else 0.0
    # Different texts are never wholly alike, even where all sampled spans are.
    return min(max(prefix, 2 * similarity / (1 + similarity)), 1.0 - 1.0 / (max(nx, ny) + 1))


_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
           "common_edited long, common_next long")
_EDGES = _RESULT + ", part int, head string, tail string"
_NAMES = [field.split()[0] for field in _EDGES.split(", ")]


_WIDTH = len(_RESULT.split(", "))


def _compared(doc_id, text: str, own: str, following: str, next_own: str) -> tuple:
    n = len(text)
    edited = text[:n - n // 2] + following[:n // 2]
    other = fingerprint(edited)
    digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, n, digest, own, other, likeness(own, other), likeness(own, next_own),
            common_prefix(text, edited), common_prefix(text, following))


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = dict(zip(_NAMES, [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string()], strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, types[n]) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names=names)


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row of an ordered partition with the next one; the ends go on for the neighbours."""
    head = last = None
    for batch in batches:
        for part in chunks(batch, "text"):
            rows = []
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                text = text.as_py() or ""
                own = fingerprint(text)
                if last:
                    rows.append((*_compared(*last, text, own), None, None, None))
                else:
                    head = text
                last = (doc_id, text, own)
            if rows:
                yield _batch(rows, _NAMES)
    if last:
        yield _batch([(last[0], *[None] * (_WIDTH - 1), TaskContext.get().partitionId(), head, last[1])], _NAMES)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, tail, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "tail", "following")), strict=True):
            yield _batch([_compared(doc_id, tail, fingerprint(tail), following, fingerprint(following))], _NAMES[:_WIDTH])


def document_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of each (doc_id, text), of its edited text, and their likeness.

    The edited text is the text with its last floor(n / 2) code points replaced by as many first ones of the
    next document, or all if it is shorter. Next is by descending doc_id, nulls last, and after the last
    comes the first; rows that share doc_id go by a hash of the text. A null text is empty; a single document is its own next.
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    and common_edited and common_next, the code points that the text begins with in common with the edited text and the next one.

    Texts are shuffled once, into ranges of doc_id that are sorted and read row by row. Only the two ends
    of each range meet those of its neighbours, in a second step over one row per range.
    """
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tie = F.xxhash64("text")
    order = [F.col("doc_id").desc_nulls_last(), tie]
    ranges = documents.select("doc_id", "text").repartitionByRange(partitions(documents.sparkSession, size, PART_BYTES), *order)
    found = written(ranges.sortWithinPartitions(*order).mapInArrow(_along, _EDGES))
    edges = found.where(F.col("part").isNotNull())
    numbers = edges.select("part")
    everything = Window.partitionBy(F.lit(0)).orderBy("part")  # one number per range
    after = F.coalesce(F.lead("part").over(everything), F.min("part").over(Window.partitionBy(F.lit(0))))
    pairs = numbers.select("part", after.alias("following_part"))
    heads = edges.select(F.col("part").alias("following_part"), F.col("head").alias("following"))
    ends = edges.select("doc_id", "part", "tail").join(pairs, "part").join(heads, "following_part").select("doc_id", "tail", "following")
    return found.where(F.col("part").isNull()).select(*_NAMES[:_WIDTH]).union(ends.mapInArrow(_across, _RESULT))
