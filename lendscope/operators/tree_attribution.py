"""Path-dependent attributions of tree ensembles.

A leaf is reached when every split condition on its path holds. With some features known and
the others averaged by training cover, its weight is a product over the path's features, one
factor each: the indicator of the condition when known, the cover share when not. The Shapley
value of such a product game is the integral over t in [0, 1] of its derivative along the
diagonal, a polynomial that Gauss-Legendre points integrate exactly.

A row matters to a leaf only by which of the path's features meet their conditions: a bit mask. So a leaf has a table of
values per mask, made once per task, and a row costs a lookup. Masks of all rows of a block are carried down a
tree together, one bit operation per edge. Small subtrees at the bottom are looked up whole: the outcomes of their splits are
further bits, and one table holds the sums over their leaves.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

from lendscope.operators.cleaning import _c
from lendscope.operators.shared_storage import cut_lineage, join_large, scratch_path

# Workers get these functions by value, so they need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 20_000
HELD_BLOCKS = 5  # blocks that share the tables of a task
MOST_BITS = 12  # a leaf with more path features is integrated row by row
JOINT_BITS = 11  # path features and splits of a subtree that is looked up whole


@dataclass(frozen=True)
class Tree:
    """A tree as lists per node: split feature and cut, children, the cover's share that goes to the lower one.

    A leaf has a negative ``lower``, a value, and its path's features with their cover shares.
    """

    feature: list[int]
    cut: list[float]
    lower: list[int]
    upper: list[int]
    share: list[float]
    value: list[float]
    paths: list[tuple[tuple[int, ...], tuple[float, ...]] | None]


@dataclass(frozen=True)
class TreeExplainer:
    features: tuple[str, ...]
    trees: tuple[Tree, ...]
    base: float


def tree_explainer(spark: SparkSession, model, features: Sequence[str]) -> TreeExplainer:
    """From a fitted Spark forest (class-1 probability) or boosted trees (log-odds, twice the raw margin)."""
    nodes, weights, boosted = _node_table(spark, model)
    total = weights.sum()
    trees, base = [], 0.0
    for number, frame in nodes.groupby("tree"):
        weight = 2 * weights[number] if boosted else weights[number] / total
        rows = frame.sort_values("id")
        place = {node: i for i, node in enumerate(rows.id)}
        at = [(place.get(a, -1), place.get(b, -1)) for a, b in zip(rows.lower, rows.upper)]
        tree = Tree(rows.feature.tolist(), rows.cut.tolist(), [a for a, _ in at], [b for _, b in at],
                    [], (weight * rows.value).tolist(), [None] * len(rows))
        cover, pending = rows.cover.tolist(), [(0, 1.0, {})]
        tree.share.extend(cover[a] / c if a >= 0 and c else 0.5 for (a, _), c in zip(at, cover))
        while pending:
            node, share, shares = pending.pop()
            if tree.lower[node] < 0:
                tree.paths[node] = (tuple(shares), tuple(shares.values()))
                base += tree.value[node] * share
                continue
            f, low = tree.feature[node], tree.share[node]
            for child, part in ((tree.lower[node], low), (tree.upper[node], 1 - low)):
                pending.append((child, share * part, {**shares, f: shares.get(f, 1.0) * part}))
        trees.append(tree)
    return TreeExplainer(tuple(features), tuple(trees), float(base))


def _node_table(spark: SparkSession, model):
    """Saved nodes as a local frame; its size is fixed by the number and depth of the trees."""
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    n = "nodeData"
    saved = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), f"{n}.id", f"{n}.prediction", f"{n}.rawCount", f"{n}.impurityStats",
        F.col(f"{n}.leftChild").alias("lower"), F.col(f"{n}.rightChild").alias("upper"),
        F.col(f"{n}.split.featureIndex").alias("feature"),
        F.get(F.col(f"{n}.split.leftCategoriesOrThreshold"), F.lit(0)).alias("cut"),
    ).toPandas()
    boosted = not hasattr(model, "numClasses") or type(model).__name__.startswith("GBT")
    if boosted:
        saved["value"] = saved["prediction"]
        saved["cover"] = [float(s[0]) for s in saved["impurityStats"]]
    else:
        saved["value"] = [float(s[1]) / max(float(sum(s)), 1e-300) for s in saved["impurityStats"]]
        saved["cover"] = [float(sum(s)) for s in saved["impurityStats"]]
    return saved, np.array(model.treeWeights, dtype=float), boosted


def _points(size: int) -> tuple[np.ndarray, np.ndarray]:
    points, weights = np.polynomial.legendre.leggauss(size // 2 + 1)
    return (points + 1) / 2, weights / 2


def mask_tables(shares: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Attributions of leaves with the same number of path features: (leaves, features, masks).

    Bit j of a mask tells whether feature j meets its condition. Products over the features before and after j are
    built up for all masks by doubling, so nothing is divided by a factor that may be 0.
    """
    leaves, size = shares.shape
    points, weights = _points(size)
    known = shares[:, :, None] + (1 - shares[:, :, None]) * points
    factors = np.stack([shares[:, :, None] * (1 - points), known], axis=-1)  # leaf, feature, point, bit
    after = [np.ones((leaves, len(points), 1))]
    for j in reversed(range(1, size)):
        after.append((after[-1][:, :, :, None] * factors[:, j, :, None, :]).reshape(leaves, len(points), -1))
    before, out = np.ones((leaves, len(points), 1)), np.empty((leaves, size, 1 << size))
    for j in range(size):
        high = after[size - 1 - j]
        others = np.einsum("lkh,lkb,k->lhb", high, before, weights) * values[:, None, None]
        change = np.stack([-shares[:, j], 1 - shares[:, j]], axis=1)
        out[:, j] = (others[:, :, None, :] * change[:, None, :, None]).reshape(leaves, -1)
        before = (factors[:, j, :, :, None] * before[:, :, None, :]).reshape(leaves, len(points), -1)
    return out


def _integrated(known: np.ndarray, shares: np.ndarray, value: float) -> np.ndarray:
    """Attributions of one leaf for rows (rows x features) by quadrature, without tables."""
    points, weights = _points(shares.size)
    out = np.zeros(known.shape)
    for t, w in zip(points, weights, strict=True):
        factor = np.where(known, shares + (1 - shares) * t, shares * (1 - t))
        before = np.cumprod(np.concatenate([np.ones((len(factor), 1)), factor[:, :-1]], axis=1), axis=1)
        after = np.cumprod(np.concatenate([np.ones((len(factor), 1)), factor[:, :0:-1]], axis=1), axis=1)[:, ::-1]
        out += w * before * after
    return out * (known - shares) * value


def _leaf_tables(tree: Tree) -> dict[int, np.ndarray]:
    """Table of each leaf with few enough path features."""
    sizes: dict[int, list[int]] = {}
    for leaf, path in enumerate(tree.paths):
        if path and 0 < len(path[0]) <= MOST_BITS:
            sizes.setdefault(len(path[0]), []).append(leaf)
    found = {}
    for size, leaves in sizes.items():
        step = max(1, (1 << 21) // (size << size))
        for at in range(0, len(leaves), step):
            some = leaves[at : at + step]
            made = mask_tables(np.array([tree.paths[i][1] for i in some]), np.array([tree.value[i] for i in some]))
            found.update(zip(some, made, strict=True))
    return found


def _reached(tree: Tree, at: int, mask: np.ndarray, bits: dict[int, int], below: Callable[[int], np.ndarray], ends):
    """Leaves, and nodes in ``ends``, under node ``at``: (node, masks, bits of its path features).

    ``below`` tells which entries meet the condition of a node's split.
    """
    pending = [(at, mask, bits)]
    while pending:
        node, mask, bits = pending.pop()
        if tree.lower[node] < 0 or node in ends:
            yield node, mask, bits
            continue
        f = tree.feature[node]
        known, bits = f in bits, bits if f in bits else {**bits, f: len(bits)}
        bit = mask.dtype.type(1 << bits[f])
        met = below(node).astype(mask.dtype) << mask.dtype.type(bits[f])
        low, high = (mask & (met | ~bit), mask & ~met) if known else (mask | met, mask | (met ^ bit))
        pending += [(tree.lower[node], low, bits), (tree.upper[node], high, bits)]


def _joint_table(tree: Tree, node: int, bits: dict[int, int], splits: Sequence[int], leaves: dict[int, np.ndarray]):
    """Features and their sums over the leaves under a node, per mask of its path features and outcomes of the splits under it."""
    entries = np.arange(1 << (len(bits) + len(splits)))
    place = {split: len(bits) + k for k, split in enumerate(splits)}
    sums: dict[int, np.ndarray] = {}
    met = _reached(tree, node, entries & ((1 << len(bits)) - 1), bits, lambda i: (entries >> place[i]) & 1 == 1, ())
    for leaf, mask, _ in met:
        for f, table in zip(tree.paths[leaf][0], leaves[leaf], strict=True):
            sums[f] = sums[f] + table[mask] if f in sums else table[mask]
    return tuple(sums), tuple(splits), np.array(list(sums.values()))


def _tables(tree: Tree) -> dict[int, tuple[tuple[int, ...], tuple[int, ...], np.ndarray]]:
    """Features, splits and table of the largest subtrees whose path features and splits fit into the bits of a table, and of other leaves with one."""
    leaves = _leaf_tables(tree)
    splits: dict[int, list[int]] = {}

    def under(node: int) -> list[int] | None:
        """The splits of a subtree, or None if it has a leaf without a table."""
        if tree.lower[node] < 0:
            found = [] if node in leaves else None
        else:
            low, high = under(tree.lower[node]), under(tree.upper[node])
            found = None if low is None or high is None else [node, *low, *high]
            found = found if found is None or len(found) <= JOINT_BITS else None
        if found is not None:
            splits[node] = found
        return found

    under(0)
    found, pending = {}, [(0, {})]
    while pending:
        node, bits = pending.pop()
        if node in splits and (len(bits) + len(splits[node]) <= JOINT_BITS or not splits[node]):
            found[node] = _joint_table(tree, node, bits, splits[node], leaves)
        elif tree.lower[node] >= 0:
            f = tree.feature[node]
            bits = bits if f in bits else {**bits, f: len(bits)}
            pending += [(tree.lower[node], bits), (tree.upper[node], bits)]
    return found


def explain_rows(tree: Tree, x: np.ndarray, phi: np.ndarray, tables: dict) -> None:
    """Add the tree's attributions of all rows to ``phi``; both are features x rows."""
    def below(i: int) -> np.ndarray:
        return x[tree.feature[i]] <= tree.cut[i]

    widest = max(JOINT_BITS, *(len(path[0]) for path in tree.paths if path))
    taken, kind = np.empty(x.shape[1]), np.int16 if widest < 15 else np.int64
    for node, mask, bits in _reached(tree, 0, np.zeros(x.shape[1], kind), {}, below, tables):
        if node in tables:
            names, splits, table = tables[node]
            for k, split in enumerate(splits, len(bits)):
                mask = mask | (below(split).astype(kind) << kind(k))
            places = mask.astype(np.intp)
            for f, values in zip(names, table, strict=True):
                phi[f] += np.take(values, places, out=taken, mode="clip")
        elif tree.paths[node][0]:
            names, shares = tree.paths[node]
            known = (mask[:, None] >> np.arange(len(names))) & 1 == 1
            phi[list(names)] += _integrated(known, np.array(shares), tree.value[node]).T


def _explained(trees: Sequence[Tree], n: int, shares: int):
    """Sums of the attributions of every ``shares``-th tree from ``share`` on: (row_no, p0, p1, ...) of rows (row_no, share, c0, c1, ...)."""

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def result() -> Iterator[pa.RecordBatch]:
            block = pa.Table.from_batches(held)
            share = block.column("share").to_numpy()
            for k in np.unique(share).tolist():
                part = block.filter(pa.array(share == k))
                x = np.stack([part.column(f"c{i}").to_numpy() for i in range(n)])
                phi = np.zeros(x.shape)
                for tree in trees[k::shares]:
                    tables = _tables(tree)
                    for at in range(0, x.shape[1], BLOCK_ROWS):
                        explain_rows(tree, x[:, at : at + BLOCK_ROWS], phi[:, at : at + BLOCK_ROWS], tables)
                yield pa.RecordBatch.from_arrays([part.column("row_no").combine_chunks(), *(pa.array(p) for p in phi)],
                                                 names=["row_no", *(f"p{i}" for i in range(n))])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= HELD_BLOCKS * BLOCK_ROWS:
                yield from result()
                held.clear()
        if held:
            yield from result()

    return explain


def _dealt(rows: int, cores: int, trees: int) -> tuple[int, int]:
    """Parts of the rows and shares of the trees, one task for each pair: as many as cores, or more where rows are many.

    A task builds the tables of its trees once for the rows it holds, which costs as much as explaining one block with them.
    """
    parts = max(1, -(-rows // (HELD_BLOCKS * BLOCK_ROWS)))
    if parts >= cores:
        return parts, 1
    parts = next(p for p in range(parts, cores + 1) if cores % p == 0)
    return parts, min(trees, cores // parts)


def tree_attributions(df: DataFrame, explainer: TreeExplainer, id_column: str = "loan_id") -> DataFrame:
    """Long attributions; per row they add up to prediction minus base.

    Parts of the rows go through all trees. Where there are fewer parts than cores, the trees are dealt out too, and the
    sums of their shares are added per row.
    """
    names = list(explainer.features)
    n = len(names)
    numbered = df.select(F.monotonically_increasing_id().alias("row_no"), _c(id_column).alias("row_id"),
                         *[_c(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    rows = cut_lineage(numbered)
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts, shares = _dealt(rows.count(), cores, len(explainer.trees))
    inputs = rows.drop("row_id").withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    if shares > 1:
        place = F.col("share") * parts + F.pmod(F.xxhash64("row_no"), F.lit(parts))
        inputs = inputs.repartitionById(shares * parts, place.cast("int"))
    else:
        inputs = inputs.coalesce(parts)
    schema = "row_no long, " + ", ".join(f"p{i} double" for i in range(n))
    summed = inputs.mapInArrow(_explained(explainer.trees, n, shares), schema)
    if shares > 1:
        summed = summed.groupBy("row_no").agg(*[F.sum(f"p{i}").alias(f"p{i}") for i in range(n)])
    entries = [F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("value"), F.col(f"p{i}").alias("shap")) for i, c in enumerate(names)]
    return join_large(rows, summed, "row_no").select("row_id", F.inline(F.array(*entries)))
