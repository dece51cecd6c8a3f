"""Near-duplicate documents: MinHash bands, odd sketches, and a check on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm import sketches as sk
from lendscope.llm.components import connected_components
from lendscope.llm.tables import columns, own_name, release, written, written_counting
from lendscope.llm.words import chunks, split_words

PERCENT = 75
LEEWAY = 0.25  # sketches reject a pair only if they put it this far below the threshold
BLOCK = 512
CHUNK = 512 << 10  # bytes of text at a time, so that hashing stays in the processor's cache

_SIGNATURE = "doc_id long, n_shingles long, a long, b long, bands array<long>, sketch array<long>"


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))


def _rows(values: np.ndarray) -> pa.Array:
    return _lists(np.ascontiguousarray(values).reshape(-1), np.arange(len(values) + 1) * values.shape[1])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text", CHUNK):
            sets, first = sk.shingle_sets(split_words(part.column("text"), lower=True))
            sampled = sk.samples(sets, first)
            digests = sk.set_digests(sets, first).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(first)), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                 _rows(sk.band_keys(sampled)), _rows(sk.odd_sketches(sampled).view(np.uint64))],
                names=["doc_id", "n_shingles", "a", "b", "bands", "sketch"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text", CHUNK):
            sets, first = sk.shingle_sets(split_words(part.column("text"), lower=True))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(sets, first)], names=["rep", "shingles"])


def _differ(x: Column, y: Column) -> Column:
    """Number of bits in which two sketches differ."""
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda total, n: total + n)


def _linked_in_block(percent: int, most_differing: float):
    """Pairs of components that a link inside one block of a bucket, or between two blocks of it, joins."""

    def links(key: tuple, table: pa.Table) -> pa.Table:
        ids, component, block = (table.column(c).to_numpy() for c in ("rep", "component", "own_block"))
        own, other = key[1].as_py(), key[2].as_py()
        sets = table.column("shingles").combine_chunks()
        first = sets.offsets.to_numpy().astype(np.int64)
        values = sets.values.to_numpy()[first[0]:first[-1]]
        first = first - first[0]
        sizes = np.diff(first)
        sketch = table.column("sketch").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
        _, code = np.unique(values, return_inverse=True)
        marked = np.zeros(len(values), bool)
        parent = {c: c for c in component.tolist()}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        found = []
        left = np.flatnonzero(block == own)
        right = np.flatnonzero(block == other)
        for i in left.tolist():
            near = right[(component[right] != component[i]) & (ids[right] > ids[i] if own == other else True)]
            near = near[np.bitwise_count(sketch[near] ^ sketch[i]).sum(axis=1) <= most_differing]
            low, high = np.minimum(sizes[near], sizes[i]), np.maximum(sizes[near], sizes[i])
            near = near[100 * low >= percent * high]
            if not len(near):
                continue
            marked[code[first[i]:first[i + 1]]] = True
            at = np.concatenate([np.arange(first[j], first[j + 1]) for j in near.tolist()])
            starts = np.concatenate([[0], np.cumsum(sizes[near])[:-1]])
            common = np.add.reduceat(marked[code[at]].astype(np.int64), starts)
            marked[code[first[i]:first[i + 1]]] = False
            for j in near[100 * common >= percent * (sizes[near] + sizes[i] - common)].tolist():
                x, y = root(component[i]), root(component[j])
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    found.append((component[i], component[j]))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"x": pairs[:, 0], "y": pairs[:, 1]})

    return links


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of (doc_id, text).

    Two documents are linked if their sets of distinct five-word shingles (A-Z lower-cased) share
    ``percent`` per cent of their union or more; component_id is the smallest doc_id that links
    reach. A document shorter than five words has its whole sequence as its shingle; null and empty
    texts have no shingle and no link. Rows with equal sets form one class; a row that repeats a doc_id
    with another text has its own class. A null doc_id takes the component of its class, if
    another row of it has an id, and is never kept.

    1. Each text gives its set's digest, 32 band keys of four MinHash samples, and the odd sketch of
       the 128 samples. At 75 % two sets share no band with probability 5e-6.
    2. Classes of equal sets are represented by their smallest doc_id. Only representatives go on, so
       a group of copies of any size costs one row.
    3. Each bucket (band key held by several) pairs its members with its smallest one. Odd sketches drop
       pairs whose estimate is below 50 %, the others are confirmed on full sets: links of a first kind.
    4. Buckets whose members now lie in one component need nothing more. In the others all pairs
       across components are examined, sketch first and then full sets, in blocks of BLOCK members;
       a task sends out no more links than join components. No pair becomes a row before it is linked. Links found here
       join whole components of the first kind, so only those take part in the second search for components.
    """
    signatures = written(documents.select("doc_id", "text").mapInArrow(_signatures, _SIGNATURE))
    # A table of its own: the joins below then deal out their sides anew, and a hot class can be split.
    classes = written(signatures.where("n_shingles > 0").groupBy("a", "b").agg(F.min("doc_id").alias("rep")))
    chosen = signatures.join(classes.select("a", "b", F.col("rep").alias("doc_id")), ["a", "b", "doc_id"], "left_semi")
    chosen = written(chosen.dropDuplicates(["a", "b"]).select(F.col("doc_id").alias("rep"), "bands", "sketch"))
    keys = chosen.select(F.explode("bands").alias("key"), "rep")
    buckets = keys.groupBy("key").agg(F.min("rep").alias("leader"), F.count("*").alias("members")).where("members > 1")
    members = written(keys.join(buckets, "key"))

    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = documents.select("doc_id", "text").join(wanted, "doc_id", "left_semi").mapInArrow(_full_sets, "rep long, shingles array<long>")
    sets = written(sets.join(chosen.select("rep", "sketch"), "rep"))

    most = sk.differing_bits(percent / 100 - LEEWAY)
    side = {n: sets.select(F.col("rep").alias(n), F.col("shingles").alias(f"{n}_set"), F.col("sketch").alias(f"{n}_sketch"))
            for n in ("x", "y")}
    stars = members.where("leader <> rep").select(F.col("leader").alias("x"), F.col("rep").alias("y")).distinct()
    close = (stars.join(side["x"].drop("x_set"), "x").join(side["y"].drop("y_set"), "y")
             .where(_differ(F.col("x_sketch"), F.col("y_sketch")) <= most).select("x", "y"))
    pairs = written(close).join(side["x"].drop("x_sketch"), "x").join(side["y"].drop("y_sketch"), "y")
    common = F.size(F.array_intersect("x_set", "y_set"))
    union = F.size("x_set") + F.size("y_set") - common
    links = written(pairs.where(100 * common >= percent * union).select("x", "y"))
    release(documents.sparkSession)
    first = written(connected_components(links))
    release(documents.sparkSession)

    labelled = written(members.join(first.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")).drop("leader"))
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    unresolved = labelled.join(mixed.select("key"), "key", "left_semi").withColumn("own_block", own)
    pair = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: F.struct(
        F.least(b, F.col("own_block")).alias("low"), F.greatest(b, F.col("own_block")).alias("high")))
    unresolved = unresolved.withColumn("pair", F.explode(pair)).join(sets, "rep")
    rest = unresolved.select("key", "pair.low", "pair.high", "rep", "component", "own_block", "sketch", "shingles").groupBy(
        "key", "low", "high").applyInArrow(_linked_in_block(percent, most), "x long, y long")
    rest, joined = written_counting(rest, F.lit(True))
    rows = signatures.select("doc_id", "n_shingles", "a", "b").join(classes, ["a", "b"], "left").join(
        first.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    if joined:  # few links are found this late; they join whole components
        last = written(connected_components(rest)).select(F.col("node").alias("component"), F.col("component").alias("whole"))
        rows = rows.join(last, "component", "left").withColumn("component", F.coalesce("whole", "component"))
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def drop_near_copies(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents without all but one of each group of near duplicates, with all their columns.

    The row of smallest doc_id stays (null last; of rows that share it, any one). Rows are known by a number of their own, so
    neither a null nor a repeated doc_id joins or loses any. Documents without words are in no group and stay.
    """
    row, component = own_name(documents, "its_row"), "component_id"
    numbered = written(documents.withColumn(row, F.monotonically_increasing_id()))
    groups = near_duplicates(numbered.select(F.col(row).alias("doc_id"), "text"), percent).select(F.col("doc_id").alias(row), component)
    ids = numbered.select(row, F.struct(F.col("doc_id").isNull(), "doc_id", row).alias("place"))
    first = ids.join(groups, row).groupBy(component).agg(F.min("place").alias("place")).select(F.col(f"place.{row}").alias(row))
    return numbered.join(first, row, "left_semi").select(*columns(documents.columns))
