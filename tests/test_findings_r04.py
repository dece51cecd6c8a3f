"""Findings of round 4: time of training runs, forest scores and tree attributions."""

import threading
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lendscope.operators import forest_scores, tree_attribution as ta
from lendscope.plans import training


def _random_tree(rng, depth, features):
    """A tree of random splits; some leaves end early, some paths meet a feature again."""
    feature, cut, lower, upper, share, value, paths = [], [], [], [], [], [], []

    def add(level, path):
        node = len(feature)
        for column, blank in ((feature, -1), (cut, 0.0), (lower, -1), (upper, -1), (share, 0.5), (value, 0.0), (paths, None)):
            column.append(blank)
        if level == depth or level > 1 and rng.random() < 0.3:
            value[node], paths[node] = float(rng.normal()), (tuple(path), tuple(path.values()))
            return node
        f = feature[node] = int(rng.integers(features))
        cut[node], share[node] = float(rng.normal()), float(rng.uniform(0, 1))
        lower[node] = add(level + 1, {**path, f: path.get(f, 1.0) * share[node]})
        upper[node] = add(level + 1, {**path, f: path.get(f, 1.0) * (1 - share[node])})
        return node

    add(0, {})
    return ta.Tree(feature, cut, lower, upper, share, value, paths)


def _leaf_by_leaf(tree, x):
    phi, pending = np.zeros(x.shape), [(0, {})]
    while pending:
        node, known = pending.pop()
        if tree.lower[node] < 0:
            names, shares = tree.paths[node]
            if names:
                phi[list(names)] += ta._integrated(np.stack([known[f] for f in names], axis=1), np.array(shares), tree.value[node]).T
            continue
        f, below = tree.feature[node], x[tree.feature[node]] <= tree.cut[node]
        for child, met in ((tree.lower[node], below), (tree.upper[node], ~below)):
            pending.append((child, {**known, f: known.get(f, True) & met}))
    return phi


def test_small_subtrees_are_looked_up_whole():
    """every leaf once had lookups of its own. The sums are those of its leaves, in wide trees as well."""
    for seed, (depth, features) in enumerate([(6, 3), (9, 12), (16, 40), (1, 2)]):
        rng = np.random.default_rng(seed)
        tree = _random_tree(rng, depth, features)
        x = rng.normal(size=(features, 300))
        x[0, :5] = np.nan
        phi, tables = np.zeros(x.shape), ta._tables(tree)
        ta.explain_rows(tree, x, phi, tables)
        assert phi == pytest.approx(_leaf_by_leaf(tree, x), abs=1e-12)
        leaves = sum(path is not None for path in tree.paths)
        assert depth == 1 or len(tables) < leaves
    assert ta._tables(ta.Tree([-1], [0.0], [-1], [-1], [0.5], [1.0], [((), ())])) == {}


def test_trees_are_dealt_out_evenly():
    """eight tasks with a few rows each built the tables of all trees."""
    assert ta._dealt(90_000, 8, 200) == (1, 8) and ta._dealt(0, 8, 3) == (1, 3)
    assert ta._dealt(150_000, 8, 200) == (2, 4) and ta._dealt(591_000, 8, 200) == (8, 1)
    assert ta._dealt(3_500_000, 8, 200) == (35, 1) and ta._dealt(100_001, 7, 200) == (7, 1)


def test_forest_votes_on_batches(spark, monkeypatch):
    """F1, F2: Spark walked 200 linked trees for each row. The scores are the very same, single-leaf trees included."""
    rows = spark.range(3000).select(F.col("id").alias("loan_id"), (F.col("id") * 37 % 101 / 7).alias("a"), (F.col("id") * 53 % 97 / 5).alias("b"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") % 89).otherwise(0.0).alias("c"), F.lit(1.0).alias("w"),
                                    (F.col("id") * 37 % 101 + F.col("id") % 13 > 60).cast("int").alias("label"))
    assembler = training._assembler(["a", "b", "c"])
    data = assembler.transform(rows).coalesce(2)
    for forest in (training.random_forest().setWeightCol("w").setNumTrees(9), RandomForestClassifier(numTrees=3, maxDepth=0, seed=2)):
        model = forest.fit(data)
        want = {r.loan_id: r.p for r in model.transform(data).select("loan_id", vector_to_array("probability")[1].alias("p")).collect()}
        with monkeypatch.context() as patch:
            patch.setattr(RandomForestClassificationModel, "transform", None)
            scored = training.score(PipelineModel([assembler, model]), rows)
            assert scored.columns == [*rows.columns, "score", "predicted"]
            found = scored.collect()
        assert {r.loan_id: r.score for r in found} == want and all(r.predicted == (r.score > 0.5) for r in found)
        x = np.array([[np.nan, 3.0, 0.0], [5.0, np.nan, 88.0]])
        plain = [model.predictProbability(Vectors.dense(row))[1] for row in x]
        assert forest_scores.vote(forest_scores.forest_votes(spark, model), x).tolist() == plain


def test_models_are_fitted_side_by_side(spark, monkeypatch):
    """one model waited for the other; the forest still has the cores for itself, and order is kept."""
    data = SimpleNamespace(train=spark.range(1))
    together, running, seen = threading.Barrier(3, timeout=20), set(), {}

    def fit(name, data, rounds):
        running.add(name)
        seen[name] = set(running)
        if name != "Random Forest":
            together.wait()
        running.discard(name)
        return training.Trained(name, None, 1.0)

    monkeypatch.setattr(training, "train_model", fit)
    fitted = training.train_all(data, training.MODELS, 5)
    assert tuple(fitted) == training.MODELS and [t.name for t in fitted.values()] == list(training.MODELS)
    assert seen["Random Forest"] == {"Random Forest"}

    def failing(name, data, rounds):
        raise ValueError(name)

    monkeypatch.setattr(training, "train_model", failing)
    with pytest.raises(ValueError):
        training.train_all(data, ["Gradient Boosting"], 5)
