"""Approximate nearest neighbours by largest inner product, over a tree of k-means."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.tables import written

NEIGHBOURS = 20
SAMPLE = 20_000  # vectors that the tree is fitted on
BRANCHES = 16
LEAF_SAMPLE = 96  # a node with no more sampled vectors is a leaf
CALIBRATION = 100  # queries that are answered exactly to set the number of leaves to visit
RECALL = 0.95  # recall that the calibration asks for
BLOCK_ROWS = 4_096  # vectors of a leaf that one task compares at a time


class Tree(NamedTuple):
    """Nodes with their centres; ``children[i]:children[i] + width[i]`` are those of node i, none for a leaf."""

    centre: np.ndarray
    children: np.ndarray
    width: np.ndarray
    leaf: np.ndarray  # number of the leaf, -1 for an inner node


def _k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    centre = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        which = _nearest(x, centre)
        counts = np.bincount(which, minlength=k)
        sums = np.zeros_like(centre)
        np.add.at(sums, which, x)
        centre = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centre)
    return centre, _nearest(x, centre)


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmin((centre * centre).sum(axis=1) - 2 * (x @ centre.T), axis=1)


def fit_tree(x: np.ndarray, branches: int = BRANCHES, leaf_sample: int = LEAF_SAMPLE, seed: int = 1) -> Tree:
    """A tree by k-means in each node, until a node has few vectors or they cannot be told apart."""
    rng = np.random.default_rng(seed)
    centre, children, width = [x.mean(axis=0)], [0], [0]
    waiting = [(0, np.arange(len(x)))]
    while waiting:
        node, rows = waiting.pop()
        k = min(branches, -(-len(rows) // (leaf_sample // 2)))
        if len(rows) <= leaf_sample or k < 2:
            continue
        centres, which = _k_means(x[rows], k, rng)
        used = np.unique(which)
        if len(used) < 2:
            continue
        children[node], width[node] = len(centre), len(used)
        for j in used:
            waiting.append((len(centre), rows[which == j]))
            centre.append(centres[j])
            children.append(0)
            width.append(0)
    width = np.array(width)
    leaf = np.where(width == 0, np.cumsum(width == 0) - 1, -1)
    return Tree(np.array(centre), np.array(children), width, leaf)


def assign(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each vector: from the root down to the nearest child."""
    node = np.zeros(len(x), np.int64)
    while True:
        inner = np.flatnonzero(tree.width[node] > 0)
        if not len(inner):
            return tree.leaf[node]
        for n in np.unique(node[inner]):
            rows = inner[node[inner] == n]
            at = tree.children[n]
            node[rows] = at + _nearest(x[rows], tree.centre[at:at + tree.width[n]])


def visits(tree: Tree, query: np.ndarray) -> Iterator[int]:
    """Leaves in best-bin-first order: the node whose centre has the largest inner product is opened next."""
    queue = [(0.0, 0)]
    while queue:
        _, node = heapq.heappop(queue)
        if not tree.width[node]:
            yield int(tree.leaf[node])
            continue
        at = tree.children[node]
        for k, near in enumerate((tree.centre[at:at + tree.width[node]] @ query).tolist()):
            heapq.heappush(queue, (-near, at + k))


def _vectors(column: pa.ChunkedArray | pa.Array, dimension: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _best(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int):
    """For each query: ids and scores of its k best rows, its own left out; ties go to the smaller id.

    A matrix product finds the candidates; their scores are then computed alike for every
    row, so that equal vectors have equal scores wherever they stand.
    """
    for start in range(0, len(queries), 256):
        rough = queries[start:start + 256] @ x.T
        rough[ids[None, :] == query_ids[start:start + 256, None]] = -np.inf
        kth = np.partition(rough, max(len(ids) - k, 0), axis=1)[:, max(len(ids) - k, 0)]
        slack = 1e-9 * (1 + np.abs(kth)) if len(ids) > k else np.inf
        keep = (rough >= (kth - slack)[:, None]) & np.isfinite(rough) if len(ids) > k else np.isfinite(rough)
        for i in range(len(rough)):
            near = np.flatnonzero(keep[i])
            score = np.einsum("ij,j->i", x[near], queries[start + i])
            order = np.lexsort((ids[near], -score))[:k]
            yield start + i, ids[near][order], score[order]


def _merge(key: tuple, table: pa.Table, k: int) -> pa.Table:
    ids = table.column("ids").combine_chunks().flatten().to_numpy()
    scores = table.column("scores").combine_chunks().flatten().to_numpy()
    order = np.lexsort((ids, -scores))[:k]
    return pa.table({"query_id": pa.array([key[0].as_py()] * len(order), pa.int64()),
                     "rank": pa.array(np.arange(1, len(order) + 1, dtype=np.int32)),
                     "vec_id": ids[order], "score": scores[order]})


def usable_vectors(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that take part, and their dimension (0 if there are none).

    Left out: null ids, null or zero vectors, vectors with null or non-finite components, and those that do not
    have the most common dimension (the smaller of equally common ones). Of rows that share a vec_id the least vector counts.
    """
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull() & finite & F.exists(vector, lambda v: v != 0))
    sizes = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").first()
    dimension = sizes.d if sizes else 0
    return rows.where(F.size(vector) == dimension).groupBy("vec_id").agg(F.min(vector).alias("x")), dimension


def nearest_neighbours(vectors: DataFrame, queries, k: int = NEIGHBOURS, vector: str = "embedding", recall: float = RECALL,
                       sample: int = SAMPLE) -> DataFrame:
    """The k rows of largest inner product for each query row: (query_id, rank, vec_id, score).

    ``queries`` is a condition on vec_id; candidates are all rows but the query's own. Scores are in double precision on
    the given vectors; ties go to the smaller vec_id. Rows that cannot take part are told by ``usable_vectors``. A query
    gets all candidates if there are fewer than k, and none if there are none.

    1. A tree of k-means is fitted on a sample of at most ``sample`` vectors (least hashes of vec_id); every row
       is then put into a leaf. The tree is small and goes to every task.
    2. Calibration: CALIBRATION queries are answered exactly, in blocks of rows, and the number of leaves is set
       so that best-bin-first visits hold ``recall`` of their true neighbours.
    3. Each query visits so many leaves, and more as long as those hold fewer than k + 1 rows. Leaves are cut into
       blocks of BLOCK_ROWS rows, so that a leaf of many equal vectors is shared among tasks; a block sends k rows per query.
    """
    rows, dimension = usable_vectors(vectors, vector)
    rows = written(rows)
    result = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    if not dimension:
        return spark.createDataFrame([], result)
    chosen = rows.orderBy(F.xxhash64("vec_id", F.lit("tree")), "vec_id").limit(sample).toArrow()
    tree = fit_tree(_vectors(chosen.column("x"), dimension))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = assign(tree, _vectors(batch.column("x"), dimension))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], names=["vec_id", "x", "leaf"])

    x_type = rows.schema["x"].dataType.simpleString()
    index = written(rows.mapInArrow(put, f"vec_id long, x {x_type}, leaf int"))
    sizes = np.zeros(int(tree.leaf.max()) + 1, np.int64)
    for row in index.groupBy("leaf").count().collect():  # a row per leaf of the tree
        sizes[row.leaf] = row["count"]

    asked = index.where(queries)
    trial = asked.orderBy(F.xxhash64("vec_id", F.lit("trial")), "vec_id").limit(CALIBRATION).select("vec_id", "x").toArrow()
    trial_ids, trial_x = trial.column("vec_id").to_numpy(), _vectors(trial.column("x"), dimension)
    if not len(trial_ids):
        return spark.createDataFrame([], result)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, leaf = batch.column("vec_id").to_numpy(), batch.column("leaf").to_numpy()
            for start in range(0, len(ids), BLOCK_ROWS):
                part = slice(start, start + BLOCK_ROWS)
                x = _vectors(batch.column("x").slice(start, BLOCK_ROWS), dimension)
                of = dict(zip(ids[part].tolist(), leaf[part].tolist(), strict=True))
                out = [(int(trial_ids[i]), found, scores, [of[v] for v in found.tolist()])
                       for i, found, scores in _best(trial_x, trial_ids, x, ids[part], k)]
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.list_(pa.int64())),
                     pa.array(columns[2], pa.list_(pa.float64())), pa.array(columns[3], pa.list_(pa.int64()))],
                    names=["query_id", "ids", "scores", "leaves"])

    def true_leaves(key: tuple, table: pa.Table) -> pa.Table:
        ids, scores, leaves = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("ids", "scores", "leaves"))
        order = np.lexsort((ids, -scores))[:k]
        return pa.table({"query_id": pa.array([key[0].as_py()] * len(order), pa.int64()), "leaf": leaves[order]})

    truth = index.mapInArrow(exact, "query_id long, ids array<long>, scores array<double>, leaves array<long>").groupBy(
        "query_id").applyInArrow(true_leaves, "query_id long, leaf long").collect()  # k rows per calibration query
    place = {int(i): {leaf: n for n, leaf in enumerate(visits(tree, x))} for i, x in zip(trial_ids, trial_x, strict=True)}
    ranks = np.sort([place[r.query_id][r.leaf] for r in truth])
    wanted = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))) - 1)]) + 1 if len(ranks) else len(sizes)
    blocks = np.maximum(-(-sizes // BLOCK_ROWS), 1)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column("x"), dimension) if batch.num_rows else []
            to, block, source = [], [], []
            for i, query in enumerate(x):
                seen, held = 0, 0
                for leaf in visits(tree, query):
                    if seen >= wanted and held > k:
                        break
                    seen, held = seen + 1, held + sizes[leaf]
                    for b in range(blocks[leaf]):
                        to.append(leaf)
                        block.append(b)
                        source.append(i)
            taken = batch.take(pa.array(source, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(block, pa.int32()), taken.column("vec_id"), taken.column("x")],
                                             names=["leaf", "block", "vec_id", "x"])

    schema = f"leaf int, block int, vec_id long, x {x_type}"
    routed = asked.mapInArrow(route, schema)
    per_leaf = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("leaf") + 1)
    stored = index.select("leaf", F.pmod(F.xxhash64("vec_id"), per_leaf).cast("int").alias("block"), "vec_id", "x")

    def compare(key: tuple, own: pa.Table, asking: pa.Table) -> pa.Table:
        ids, scores, who = [], [], []
        if own.num_rows and asking.num_rows:
            asking_ids = asking.column("vec_id").to_numpy()
            for i, found, score in _best(_vectors(asking.column("x"), dimension), asking_ids, _vectors(own.column("x"), dimension),
                                         own.column("vec_id").to_numpy(), k):
                who.append(int(asking_ids[i]))
                ids.append(found)
                scores.append(score)
        return pa.table({"query_id": pa.array(who, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int64())),
                         "scores": pa.array(scores, pa.list_(pa.float64()))})

    found = stored.groupBy("leaf", "block").cogroup(routed.groupBy("leaf", "block")).applyInArrow(
        compare, "query_id long, ids array<long>, scores array<double>")
    return found.groupBy("query_id").applyInArrow(lambda key, table: _merge(key, table, k), result)
