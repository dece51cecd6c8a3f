"""Properties of splits, oversampling, models, attributions and detectors."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendscope.operators import cleaning, isolation, oversampling, reconstruction, sampling
from lendscope.operators.tree_attribution import tree_attributions, tree_explainer
from lendscope.plans import anomaly_run, sequence_run, training

FEATURES = ["x0", "x1", "x2"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(1500, 3))
    label = (x[:, 0] + x[:, 1] + rng.normal(scale=0.5, size=1500) > 1.2).astype(int)
    rows = pd.DataFrame(x, columns=FEATURES).assign(y=label, loan_id=range(1500), grade="A")
    rows.loc[::50, "x2"] = np.nan
    return spark.createDataFrame(rows).cache()


@pytest.fixture(scope="module")
def data(table):
    return training.prepare(table, "y")


def test_split_is_stratified(table):
    parts = sampling.stratified_split(table, "y").groupBy("split").agg(F.count("y"), F.avg("y")).collect()
    shares = {r[0]: (r[1], r[2]) for r in parts}
    overall = table.agg(F.avg("y")).first()[0]
    assert shares["test"][0] == pytest.approx(225, abs=1) and shares["validation"][0] == pytest.approx(225, abs=1)
    assert all(abs(rate - overall) < 0.01 for _, rate in shares.values())


def test_prepared_frames(data, table):
    assert data.features == FEATURES
    sizes = {r[0]: r[1] for r in data.train.groupBy("label").count().collect()}
    assert sizes[0] == sizes[1]
    assert data.train.filter(" or ".join(f"{c} is null or isnan({c})" for c in FEATURES)).isEmpty()
    assert data.validation.count() + data.test.count() < table.count()


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = sampling.scale(df, sampling.fit_scaler(df, ["a", "b"])).collect()
    assert [tuple(r) for r in scaled] == [(-1.0, 0.0), (1.0, 0.0)]


def test_synthetic_rows_lie_on_segments(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(200, 2))
    rows = pd.DataFrame(x, columns=["a", "b"]).assign(y=[1] * 30 + [0] * 170, loan_id=range(200))
    made = oversampling.synthetic_minority(spark.createDataFrame(rows), ["a", "b"], "y").toPandas()
    assert len(made) == 140 and set(made.y) == {1}
    minority = x[:30]
    for r in made.itertuples():
        base, near = minority[r.base_key], np.array(r.neighbour)
        rank = np.sort(((minority - base) ** 2).sum(1))[5]
        assert ((near - base) ** 2).sum() <= rank + 1e-12
        along = np.dot(np.array([r.a, r.b]) - base, near - base) / max(np.dot(near - base, near - base), 1e-300)
        assert -1e-9 <= along <= 1 + 1e-9
        assert np.array([r.a, r.b]) == pytest.approx(base + along * (near - base))


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert sampling.class_weights(df, "y") == {0: 4 / 6, 1: 2.0}


@pytest.mark.parametrize("name", ["Logistic Regression", "Random Forest"])
def test_models_separate(data, name):
    fitted = training.train_model(name, data)
    scored = training.score(fitted.model, data.test)
    assert scored.filter("score < 0 or score > 1 or predicted not in (0, 1)").isEmpty()
    metrics = training.compare_models({name: fitted}, data.test).first()
    assert metrics["auc_roc"] > 0.85 and metrics["train_time_sec"] > 0


def test_boosting_stops_early(data):
    model, rounds = training.fit_boosted(data, weighted=True, rounds=12, patience=3, first_rounds=4)
    assert 1 <= rounds <= 12 and model.stages[-1].getNumTrees == rounds
    assert training.score(model, data.test).filter("score between 0 and 1").count() == data.test.count()


def test_patience_rule():
    assert training.patient_rounds([5, 4, 3, 3.5, 3.6], 2) == (3, True)
    assert training.patient_rounds([5, 4, 3, 3.5], 2) == (3, False)
    assert training.patient_rounds([1, 2, 3, 0.5], 2) == (1, True)


def _brute_force(predict, x, background_value, n):
    """Shapley values from all subsets; predict takes the set of known features."""
    values = np.zeros(n)
    for j in range(n):
        others = [i for i in range(n) if i != j]
        for size in range(n):
            for known in itertools.combinations(others, size):
                weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                values[j] += weight * (predict(x, {*known, j}) - predict(x, set(known)))
    return values


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_tree_attributions(spark, data, kind):
    from pyspark.ml.classification import RandomForestClassifier

    train = training._assembler(FEATURES).transform(data.train)
    model = (
        RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=4, maxDepth=4, seed=1)
        if kind == "forest" else training.boosted_trees(3, False)
    ).fit(train)
    explainer = tree_explainer(spark, model, FEATURES)
    sample = training._assembler(FEATURES).transform(data.test.orderBy("loan_id").limit(20))
    long = tree_attributions(sample, explainer).toPandas().pivot(index="row_id", columns="feature", values="shap")[FEATURES]
    p = vector_to_array("probability")[1]
    column = p if kind == "forest" else F.log(p / (1 - p))
    wanted = model.transform(sample).select("loan_id", column.alias("p"), *FEATURES).toPandas().set_index("loan_id")
    assert (long.sum(axis=1) + explainer.base).to_numpy() == pytest.approx(wanted.loc[long.index].p.to_numpy())

    def follow(tree, node, x, known):
        if tree.lower[node] < 0:
            return tree.value[node]
        low, high = (follow(tree, child, x, known) for child in (tree.lower[node], tree.upper[node]))
        f = tree.feature[node]
        return (low if x[f] <= tree.cut[node] else high) if f in known else tree.share[node] * low + (1 - tree.share[node]) * high

    def predict(x, known):
        return sum(follow(tree, 0, x, known) for tree in explainer.trees)

    row = long.index[0]
    expected = _brute_force(predict, wanted.loc[row, FEATURES].to_numpy(), None, 3)
    assert long.loc[row].to_numpy() == pytest.approx(expected)


def test_isolation_scores(spark, table):
    matrix = cleaning.feature_matrix(table, "y", "loan_id")
    outlier = spark.createDataFrame([(9999, 40.0, -40.0, 40.0, 0)], matrix.schema)
    rows = matrix.unionByName(outlier)
    forest = isolation.fit_isolation_forest(rows, FEATURES, trees=50)
    scored = isolation.score_isolation(rows, forest).toPandas().set_index("loan_id").iso_forest_score
    assert scored.between(0, 1, inclusive="neither").all() and scored.idxmax() == 9999


def test_full_bottleneck_has_no_error(table):
    matrix = cleaning.feature_matrix(table, "y", "loan_id")
    full = reconstruction.score_reconstruction(matrix, reconstruction.fit_bottleneck(matrix, FEATURES, 3, "linear"))
    assert full.agg(F.max("reconstruction_error")).first()[0] < 1e-9
    narrow = reconstruction.score_reconstruction(matrix, reconstruction.fit_bottleneck(matrix, FEATURES, 1, "linear"))
    assert narrow.agg(F.min("reconstruction_error")).first()[0] >= 0


def test_anomaly_run_flags_about_one_percent(spark):
    rng = np.random.default_rng(11)
    wide = pd.DataFrame(rng.normal(size=(1500, 12)), columns=[f"f{i}" for i in range(12)])
    table = spark.createDataFrame(wide.assign(y=rng.integers(0, 2, 1500), loan_id=range(1500)))
    flagged = anomaly_run.anomaly_table(table, "y")
    counts = flagged.agg(F.count_if("is_iso_anomaly"), F.count_if("is_ae_anomaly"), F.count_if("strong_anomaly_flag")).first()
    assert 1 <= counts[0] <= 90 and counts[1] == 15 and counts[2] <= min(counts[0], counts[1])


def test_sequence_classifier_ranks_rising_balances(spark):
    rng = np.random.default_rng(3)
    rows = [(k, t, float(rng.normal())) for k in range(120) for t in range(6)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    scored = sequence_run.sequence_run(df, "k", ["t"], ["v"])
    means = {r[0]: r[1] for r in scored.groupBy("label").agg(F.avg("score")).collect()}
    assert scored.count() == 240 and means[1] > means[0]


def test_too_few_rows_for_a_sequence(spark):
    with pytest.raises(ValueError):
        sequence_run.sequence_run(spark.createDataFrame([(1, 1, 1.0)], "k int, t int, v double"), "k", ["t"], ["v"])


def test_saved_pipeline_scores_raw_features(spark, data, table, tmp_path):
    fitted = training.train_model("Logistic Regression", data)
    path = str(tmp_path / "model")
    training.scoring_pipeline(fitted, data).write().save(path)
    again = training.score(PipelineModel.load(path), table.select("loan_id", *FEATURES)).select("loan_id", F.col("score").alias("again"))
    both = training.score(fitted.model, data.test).join(again, "loan_id")
    assert both.count() == data.test.count() and both.agg(F.max(F.abs(F.col("score") - F.col("again")))).first()[0] < 1e-9


def test_explanations_cover_every_test_row(spark, data):
    fitted = training.train_model("Logistic Regression", data)
    assert training.explain(fitted, data).count() == len(FEATURES) * data.test.count()


def test_isolation_draws_by_one_rule(spark):
    rows = spark.range(3000).select(F.col("id").alias("loan_id"), F.rand(1).alias("a"), F.rand(2).alias("b"))
    for n in (100, 3000):
        forest = isolation.fit_isolation_forest(rows.limit(n), ["a", "b"], trees=9, rows_per_tree=256)
        assert len(forest.trees) == 9 and forest.rows_per_tree == min(n, 256)
