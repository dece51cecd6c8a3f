"""The trainer of small networks, what is built on it, and ensembles cut to their first trees."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lendscope.operators import networks, reconstruction, tree_attribution
from lendscope.operators.networks import Autoencoder, Fitted, Gated, Training
from lendscope.operators.tree_attribution import _integrated, mask_tables
from lendscope.plans import sequence_run, training
from lendscope.plans.ensembles import first_trees


@pytest.mark.parametrize("network", [Gated(2, 4, hidden=5, dense=3), Autoencoder(4, widths=(5, 3), bottleneck=2)])
def test_gradients_agree_with_differences(network):
    rng = np.random.default_rng(1)
    width = 8 if isinstance(network, Gated) else 4
    x, y = rng.normal(size=(7, width)), rng.integers(0, 2, 7).astype(float)
    p = [v + rng.normal(scale=0.1, size=v.shape) for v in network.start(rng)]
    _, gradients = network.gradients(p, x, y)
    for k, v in enumerate(p):
        for at in list(np.ndindex(v.shape))[:12]:
            kept, e = v[at], 1e-6
            v[at] = kept + e
            up = network.gradients(p, x, y)[0]
            v[at] = kept - e
            down = network.gradients(p, x, y)[0]
            v[at] = kept
            assert gradients[k][at] == pytest.approx((up - down) / (2 * e) / len(x), abs=1e-6)


def _plain_gated(network, p, row):
    """One sequence through the unit, number by number."""
    def sigmoid(z):
        return 1 / (1 + np.exp(-z))

    w, u, b, c = p[:4]
    h, state = network.hidden, np.zeros(network.hidden)
    for step in row.reshape(network.steps, network.inputs):
        update = sigmoid(step @ w[:, :h] + state @ u[:, :h] + b[:h])
        reset = sigmoid(step @ w[:, h : 2 * h] + state @ u[:, h : 2 * h] + b[h : 2 * h])
        new = np.tanh(step @ w[:, 2 * h :] + b[2 * h :] + reset * (state @ u[:, 2 * h :] + c))
        state = update * state + (1 - update) * new
    return sigmoid(np.maximum(state @ p[4] + p[5], 0) @ p[6] + p[7])[0]


def test_gated_scores_agree_with_plain_ones(spark, tmp_path):
    network = Gated(2, 3, hidden=4, dense=3)
    rng = np.random.default_rng(2)
    fitted = Fitted(network, network.start(rng))
    rows = [(i, rng.normal(size=6).tolist()) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    again = Fitted.load(spark, network, fitted.save(spark, str(tmp_path / "network")))
    for model in (fitted, again):
        got = {r["id"]: r["out"] for r in networks.apply(df, model, F.col("x"), "out").collect()}
        assert all(got[i] == pytest.approx(_plain_gated(network, fitted.parameters, np.array(x))) for i, x in rows)


def test_averages_over_many_tasks(spark, monkeypatch):
    """Many small tasks and a tree of sums still learn, and no task holds more than its share."""
    monkeypatch.setattr(networks, "TASK_ROWS", 50)
    monkeypatch.setattr(networks, "FAN_IN", 3)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1000, 2))
    df = spark.createDataFrame([(r.tolist(), float(r[0] > 0)) for r in x], "x array<double>, y double")
    fitted = networks.train(df, Gated(1, 2, hidden=4, dense=4), Training(epochs=30, batch=10, rate=0.01))
    assert len(fitted.losses) == 6 and fitted.losses[-1] < 0.2 < fitted.losses[0]


def test_training_on_nothing_raises(spark):
    with pytest.raises(ValueError):
        networks.train(spark.createDataFrame([], "x array<double>, y double"), Gated(1, 2), Training(1, 8, 0.1))


def _area(scored):
    rows = scored.select("label", "score").toPandas()
    ranks = rows.score.rank()
    ones = rows.label == 1
    return (ranks[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_order_of_steps_matters(spark):
    """Default where a balance turns: no weighted sum of steps can tell, a recurrent unit can."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(4000, 3))
    turns = (v[:, 0] < v[:, 1]) != (v[:, 1] < v[:, 2])
    rows = [(i, 0, int(t), [[float(s)] for s in x]) for i, (x, t) in enumerate(zip(v, turns, strict=True))]
    rows[0] = (0, 0, rows[0][2], [[None], [float("nan")], [1.0]])
    df = spark.createDataFrame(rows, "k int, seq_no int, label int, steps array<array<double>>")
    learn, held = df.filter("k < 3000"), df.filter("k >= 3000")
    plan = Training(epochs=40, batch=64, rate=1e-2)
    recurrent = sequence_run.fit_sequence_classifier(learn, ["v"], 3, training=plan)
    regression = sequence_run.fit_sequence_classifier(learn.filter("k > 0"), ["v"], 3, method="regression")
    areas = [_area(sequence_run.score_sequences(m, held, ["v"], 3, "k")) for m in (recurrent, regression)]
    assert areas[0] > 0.9 > 0.7 > areas[1]
    assert sequence_run.score_sequences(recurrent, df.filter("k = 0"), ["v"], 3, "k").first()["score"] is not None


def test_network_follows_a_curved_surface(spark):
    rng = np.random.default_rng(6)
    angle = rng.uniform(-np.pi, np.pi, 4000)
    points = np.column_stack([np.cos(angle), np.sin(angle), np.cos(2 * angle), np.sin(2 * angle)]) + rng.normal(scale=0.01, size=(4000, 4))
    df = spark.createDataFrame(pd.DataFrame(points, columns=list("abcd")).assign(loan_id=range(4000)))
    plan = Training(epochs=60, batch=64, rate=3e-3, patience=10)
    errors = {}
    for method in ("network", "linear"):
        fitted = reconstruction.fit_bottleneck(df.filter("loan_id < 3000"), list("abcd"), 2, method, plan)
        scored = reconstruction.score_reconstruction(df.filter("loan_id >= 3000"), fitted)
        errors[method] = scored.agg(F.avg("reconstruction_error")).first()[0]
        inside = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0)], "a double, b double, c double, d double")
        errors[method, "off"] = reconstruction.score_reconstruction(inside, fitted).first()["reconstruction_error"]
    assert errors["network"] < errors["linear"] / 3
    assert errors["network", "off"] > errors["linear", "off"]


def test_unknown_methods_raise(spark):
    df = spark.createDataFrame([(1.0, [[1.0]], 0)], "a double, steps array<array<double>>, label int")
    with pytest.raises(ValueError):
        reconstruction.fit_bottleneck(df, ["a"], method="none")
    with pytest.raises(ValueError):
        sequence_run.fit_sequence_classifier(df, ["a"], 1, method="none")


def test_first_trees_equal_a_shorter_fit(spark):
    df = spark.range(800).selectExpr("id", "rand(1) a", "rand(2) b", "cast(rand(1) + rand(3) > 1 as int) label", "1D class_weight")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol=training.VECTOR).transform(df).coalesce(1).cache()
    cut = first_trees(spark, training.boosted_trees(7, True).fit(rows), 3)
    short = training.boosted_trees(3, True).fit(rows)
    assert cut.getNumTrees == 3 and list(cut.treeWeights) == list(short.treeWeights)
    scores = [[r.probability[1] for r in m.transform(rows).orderBy("id").select("probability").collect()] for m in (cut, short)]
    assert scores[0] == scores[1]
    with pytest.raises(ValueError):
        first_trees(spark, short, 4)


def test_boosting_fits_each_length_once(spark, monkeypatch):
    """The best length is cut out of the fit that showed it."""
    lengths = []
    fit = training.boosted_trees
    monkeypatch.setattr(training, "boosted_trees", lambda rounds, weighted: lengths.append(rounds) or fit(rounds, weighted))
    rng = np.random.default_rng(9)
    table = pd.DataFrame(rng.normal(size=(600, 2)), columns=["a", "b"]).assign(y=rng.integers(0, 2, 600), loan_id=range(600))
    data = training.prepare(spark.createDataFrame(table), "y", balance=False)
    model, rounds = training.fit_boosted(data, False, rounds=12, patience=3, first_rounds=6)
    assert lengths in ([6], [6, 12]) and model.stages[-1].getNumTrees == rounds <= lengths[-1]


def test_mask_tables_agree_with_row_by_row_values():
    """Every mask of leaves of many sizes, a share of 0 and one of 1 among them."""
    rng = np.random.default_rng(8)
    for size in range(1, 8):
        shares, values = rng.uniform(size=(3, size)), rng.normal(size=3)
        shares[0, 0], shares[1, -1] = 0, 1
        tables = mask_tables(shares, values)
        masks = np.arange(1 << size)
        known = (masks[:, None] >> np.arange(size)) & 1 == 1
        for leaf in range(3):
            assert tables[leaf].T == pytest.approx(_integrated(known, shares[leaf], values[leaf]), abs=1e-12)
            whole = np.where(known, 1.0, 0.0).prod(axis=1) - shares[leaf].prod()
            assert tables[leaf].sum(axis=0) == pytest.approx(values[leaf] * whole, abs=1e-12)


def test_wide_leaves_need_no_table(spark, monkeypatch):
    df = spark.range(900).selectExpr("id as loan_id", "rand(1) a", "rand(2) b", "rand(4) c", "cast(rand(1) + rand(2) > 1 as int) label", "1D class_weight")
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol=training.VECTOR).transform(df).coalesce(1)
    explainer = tree_attribution.tree_explainer(spark, training.boosted_trees(3, True).fit(rows), ["a", "b", "c"])
    found = []
    for bits, block in ((12, 20_000), (1, 100)):
        monkeypatch.setattr(tree_attribution, "MOST_BITS", bits)
        monkeypatch.setattr(tree_attribution, "BLOCK_ROWS", block)
        long = tree_attribution.tree_attributions(df, explainer).toPandas()
        found.append(long.sort_values(["row_id", "feature"]).shap.to_numpy())
    assert len(found[0]) == 2700 and found[0] == pytest.approx(found[1], abs=1e-12)
