"""Class probabilities of a forest, tree by tree for a batch of rows (M6).

Spark walks all trees for one row after the other through linked nodes, which mostly waits for memory. Here the nodes of a
tree are arrays, and a whole batch goes down one level at a time. Votes are added in the order of the trees, so sums are the same.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, SparkSession, functions as F

from lendscope.operators.shared_storage import scratch_path

# Workers get these functions by value, so they need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Votes:
    """A tree as arrays per node: split feature and cut, upper and lower child in turn, shares of the two classes.

    A leaf is its own child; ``depth`` steps lead from the root to the leaf of any row.
    """

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    shares: tuple[np.ndarray, np.ndarray]
    depth: int


@lru_cache(maxsize=4)
def forest_votes(spark: SparkSession, model: RandomForestClassificationModel) -> tuple[Votes, ...]:
    """The trees of a fitted forest of two classes from its saved nodes; their size is fixed by the number and depth of the trees."""
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    n = "nodeData"
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), f"{n}.id", F.col(f"{n}.impurityStats").alias("counts"), F.col(f"{n}.leftChild").alias("lower"),
        F.col(f"{n}.rightChild").alias("upper"), F.col(f"{n}.split.featureIndex").alias("feature"),
        F.get(F.col(f"{n}.split.leftCategoriesOrThreshold"), F.lit(0)).alias("cut"),
    ).toPandas()
    return tuple(_votes(frame.sort_values("id")) for _, frame in nodes.groupby("tree", sort=True))


def _votes(nodes) -> Votes:
    own, leaf = np.arange(len(nodes)), (nodes.lower < 0).to_numpy()
    lower, upper = (np.where(leaf, own, np.searchsorted(nodes.id.to_numpy(), nodes[side].to_numpy())) for side in ("lower", "upper"))
    counts = np.stack(nodes.counts.to_numpy()).astype(float)
    total = counts.sum(axis=1)
    shares = np.divide(counts, total[:, None], out=np.zeros(counts.shape), where=total[:, None] != 0)
    depth, level = 0, np.zeros(1, np.int64)
    while len(level := level[~leaf[level]]):
        level, depth = np.concatenate([lower[level], upper[level]]), depth + 1
    return Votes(np.where(leaf, 0, nodes.feature.to_numpy()).astype(np.int64), np.where(leaf, np.inf, nodes.cut.to_numpy(float)),
                 np.stack([upper, lower], axis=1).ravel(), (shares[:, 0].copy(), shares[:, 1].copy()), depth)


def vote(trees: Sequence[Votes], x: np.ndarray) -> np.ndarray:
    """Share of class 1 in the votes of all trees; ``x`` is rows x features."""
    rows, width = x.shape
    values, start = np.ascontiguousarray(x).ravel(), np.arange(rows) * width
    at, value, cut, share = np.empty(rows, np.int64), np.empty(rows), np.empty(rows), np.empty(rows)
    sums = np.zeros(rows), np.zeros(rows)
    for tree in trees:
        node, following = np.zeros(rows, np.int64), np.empty(rows, np.int64)
        for _ in range(tree.depth):
            np.take(tree.feature, node, out=at, mode="clip")
            at += start
            np.take(values, at, out=value, mode="clip")
            np.take(tree.cut, node, out=cut, mode="clip")
            node *= 2
            node += value <= cut
            np.take(tree.child, node, out=following, mode="clip")
            node, following = following, node
        for total, shares in zip(sums, tree.shares, strict=True):
            total += np.take(shares, node, out=share, mode="clip")
    whole = sums[0] + sums[1]
    return np.divide(sums[1], whole, out=np.zeros(rows), where=whole != 0)


def _voting(trees: Sequence[Votes]) -> Callable[[pa.Array], pa.Array]:
    def probability(vectors: pa.Array) -> pa.Array:
        return pa.array(vote(trees, vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)))

    return probability


def forest_probability(spark: SparkSession, model: RandomForestClassificationModel, vectors: Column) -> Column:
    """P(class 1) of a column of feature arrays."""
    return F.arrow_udf(_voting(forest_votes(spark, model)), "double")(vectors)
