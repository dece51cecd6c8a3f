"""Isolation forest (A1): trees are grown in parallel, rows are scored where they lie."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendscope import fixed_values as fx
from lendscope.operators.cleaning import _c
from lendscope.operators.shared_storage import cut_lineage

EULER = 0.5772156649015329
NODE_SCHEMA = "tree int, node int, feature int, cut double, lower int, upper int, path double"


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    if n <= 1:
        return 0.0
    return 1.0 if n == 2 else 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


@dataclass(frozen=True)
class IsolationForest:
    """Node table per tree; leaves have feature -1 and the path length that ends there."""

    features: tuple[str, ...]
    trees: tuple[dict, ...]
    rows_per_tree: int


def fit_isolation_forest(
    df: DataFrame,
    features: Sequence[str],
    id_column: str = "loan_id",
    trees: int = fx.ISOLATION_TREES,
    rows_per_tree: int = fx.ISOLATION_ROWS,
    seed: int = fx.SEED,
) -> IsolationForest:
    """Grow each tree on its own random rows: those whose hashes with the tree's number are least.

    Trees draw independently, whatever the number of rows. A row goes to a tree only if its hash
    is below a bound that leaves each tree a few rows more than it needs, so the draw costs one pass and
    every group below has a bounded size.
    """
    features = list(features)
    source = df.select(_c(id_column).alias("_id"), *[_c(c) for c in features])
    held = source.count()
    bound = min(1.0, (rows_per_tree + 8 * math.sqrt(rows_per_tree) + 16) / max(held, 1))

    def number(tree: Column) -> Column:
        return F.xxhash64("_id", tree, F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1))

    def draw(tree: Column) -> Column:
        return number(tree) / float(1 << 52)

    order = Window.partitionBy("tree").orderBy("_draw", "_id")

    def drawn_below(limit: float) -> DataFrame:
        below = F.lit(math.ceil(limit * 2.0**52))  # the same test as draw(tree) < limit, in whole numbers
        chosen = F.filter(F.expr(f"sequence(0, {trees - 1})"), lambda tree: number(tree) < below)
        offered = source.withColumn("tree", F.explode(chosen)).withColumn("_draw", draw(F.col("tree")))
        placed = offered.withColumn("_place", F.row_number().over(order))
        return cut_lineage(placed.filter(F.col("_place") <= rows_per_tree).drop("_place"))

    drawn = drawn_below(bound)
    if bound < 1 and drawn.count() < trees * rows_per_tree:  # about once in 10**15 draws
        drawn = drawn_below(min(1.0, 4 * bound))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        def leaf_path(n):
            if n <= 1:
                return 0.0
            return 1.0 if n == 2 else 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n

        number = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, number])
        x = pdf.sort_values("_draw")[features].to_numpy(float)
        limit = math.ceil(math.log2(max(2, len(x))))
        nodes, pending = [], [(0, np.arange(len(x)), 0)]
        count = 1
        while pending:
            node, rows, depth = pending.pop()
            part = x[rows]
            varied = np.flatnonzero(np.ptp(part, axis=0) > 0) if len(rows) > 1 else []
            if depth >= limit or len(varied) == 0:
                nodes.append((number, node, -1, 0.0, -1, -1, depth + leaf_path(len(rows))))
                continue
            feature = int(rng.choice(varied))
            values = part[:, feature]
            cut = float(rng.uniform(values.min(), values.max()))
            low = values <= cut
            nodes.append((number, node, feature, cut, count, count + 1, 0.0))
            pending += [(count, rows[low], depth + 1), (count + 1, rows[~low], depth + 1)]
            count += 2
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "lower", "upper", "path"])

    nodes = drawn.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    size = min(rows_per_tree, held)
    grown = []
    for _, t in nodes.sort_values(["tree", "node"]).groupby("tree"):
        grown.append({c: t[c].to_numpy() for c in ("feature", "cut", "lower", "upper", "path")})
    return IsolationForest(tuple(features), tuple(grown), size)


def _walkable(tree: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Feature, cut, children (lower, upper) and path per node, and the depth. A leaf is its own child, so all rows take as many steps."""
    split, own = tree["feature"] >= 0, np.arange(len(tree["feature"]))
    children = np.column_stack([np.where(split, tree[side], own) for side in ("lower", "upper")]).astype(np.intp)
    level, depth = np.zeros(1, dtype=np.intp), 0
    while split[level].any():
        level, depth = np.unique(children[level]), depth + 1
    return np.where(split, tree["feature"], 0).astype(np.intp), tree["cut"], children.ravel(), tree["path"], depth


def isolation_score(forest: IsolationForest):
    """Column of anomaly scores 2^(-mean path / expected path), higher is more anomalous."""
    trees, expected = [_walkable(t) for t in forest.trees], average_path(forest.rows_per_tree)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        n = len(columns[0])
        x = np.concatenate([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])  # one feature after the other
        total = np.zeros(n)
        for start in range(0, n, 2_048):  # few enough rows for the caches
            rows = np.arange(start, min(n, start + 2_048))
            for feature, cut, children, path, depth in trees:
                node = np.zeros(len(rows), dtype=np.intp)
                for _ in range(depth):
                    low = x.take(feature.take(node) * n + rows) <= cut.take(node)
                    node = children.take(2 * node + ~low)
                total[rows] += path.take(node)
        return pd.Series(2.0 ** (-total / len(trees) / expected))

    return score(*[_c(c).cast("double") for c in forest.features])


def score_isolation(df: DataFrame, forest: IsolationForest, output: str = "iso_forest_score") -> DataFrame:
    return df.withColumn(output, isolation_score(forest))
