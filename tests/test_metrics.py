"""Metric values on small cases with known answers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import anomalies, attribution, evaluation, histograms, loss, reporting


def scores(spark, labels, values):
    return spark.createDataFrame([("m", int(y), float(s)) for y, s in zip(labels, values, strict=True)], "model string, label int, score double")


def test_tied_case(spark):
    m = evaluation.model_comparison(scores(spark, [1, 0, 1, 1, 0], [0.9, 0.8, 0.7, 0.6, 0.6])).first()
    assert (m["auc_roc"], m["ks_statistic"], m["pr_auc"]) == pytest.approx((0.583333, 0.333333, 0.755556), abs=1e-6)


def test_perfect_and_random_ks(spark):
    perfect = scores(spark, [1, 0, 1, 0], [0.64, 0.11, 0.63, 0.62])
    assert evaluation.ks_statistic(perfect).first()["ks_statistic"] == 1.0
    # Labels that alternate along the scores separate nothing but one step.
    alternating = scores(spark, [i % 2 for i in range(400)], [i / 400 for i in range(400)])
    assert evaluation.ks_statistic(alternating).first()["ks_statistic"] == pytest.approx(1 / 200)


def test_gini_identity(spark):
    m = evaluation.auc_gini(scores(spark, [1, 0, 1, 0, 1], [0.35, 0.15, 0.05, 0.55, 0.75])).first()
    assert m["auc_roc"] == pytest.approx(3 / 6) and m["gini"] == pytest.approx(0, abs=1e-12)


def test_all_tied_and_single_class(spark):
    assert evaluation.auc_gini(scores(spark, [0, 1, 1], [0.5, 0.5, 0.5])).first()["auc_roc"] == 0.5
    assert evaluation.auc_gini(scores(spark, [1, 1], [0.5, 0.6])).first()["auc_roc"] is None


def test_undefined_precision_is_zero(spark):
    rates = evaluation.label_rates(evaluation.confusion_counts(scores(spark, [0, 1], [0.1, 0.2]))).first()
    assert (rates["precision"], rates["recall"], rates["f1_score"], rates["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_roc_curve_encloses_the_auc(spark):
    rng = np.random.default_rng(1)
    df = scores(spark, rng.integers(0, 2, 300), np.round(rng.random(300), 2))
    points = evaluation.roc_points(df).toPandas().sort_values(["fpr", "tpr"])
    assert np.trapezoid(points.tpr, points.fpr) == pytest.approx(evaluation.auc_gini(df).first()["auc_roc"])
    assert points.iloc[0][["fpr", "tpr"]].tolist() == [0, 0] and points.iloc[-1][["fpr", "tpr"]].tolist() == [1, 1]


def test_ks_grid_matches_direct_counts(spark):
    rng = np.random.default_rng(4)
    label, value = rng.integers(0, 2, 400), np.round(rng.random(400), 3)
    curve = evaluation.ks_curve(scores(spark, label, value)).toPandas().sort_values("point")
    grid = np.linspace(0, 1, 500)
    assert curve.cdf_default.to_numpy() == pytest.approx([(value[label == 1] <= t).mean() for t in grid])
    assert curve.cdf_non_default.to_numpy() == pytest.approx([(value[label == 0] <= t).mean() for t in grid])


@pytest.mark.parametrize("values", [[0.0, 0.1, 0.2, 0.3, 1.0], [5.0, 5.0], list(np.random.default_rng(0).normal(size=500))])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    got = {r["bin"]: r["n"] for r in histograms.histogram(df, "x", 50).collect()}
    counts, _ = np.histogram(values, 50)
    assert got == {i: int(n) for i, n in enumerate(counts) if n}


def test_expected_loss_arithmetic(spark):
    one = spark.createDataFrame([(0.4, 50.0)], "pd_predicted double, e double")
    assert loss.expected_loss(one, ead="e").first()["expected_loss"] == pytest.approx(0.4 * 0.45 * 50)
    three = spark.createDataFrame([(0.5, 8.0), (0.25, 160.0), (1.0, 2.0)], "pd_predicted double, e double")
    assert loss.expected_loss(three, ead="e", lgd=0.5).agg(F.sum("expected_loss")).first()[0] == pytest.approx(2 + 20 + 1)
    assert loss.expected_loss(spark.createDataFrame([(0.0,)], "pd_predicted double")).first()["expected_loss"] == 0


def test_ungraded_loans_count_in_the_share_only(spark):
    df = spark.createDataFrame([(0.01,), (0.3,), (1.5,), (0.02,)], "pd_predicted double")
    segments = {r["risk_grade"][0]: r for r in loss.segment_summary(loss.grade_loans(loss.expected_loss(df))).collect()}
    assert set(segments) == {"A", "D"} and segments["A"]["pct_of_portfolio"] == 50.0


def test_rate_ratio_floor(spark):
    df = spark.createDataFrame([(1, True, True), (0, False, False)], "label int, is_iso_anomaly boolean, is_ae_anomaly boolean")
    audit = anomalies.anomaly_audit(anomalies.flag_ensemble(df)).first()
    assert audit["rate_ratio"] == pytest.approx(100 / 0.001)


def test_only_isolation_flag(spark):
    df = spark.createDataFrame([(True,)], "is_iso_anomaly boolean")
    assert anomalies.flag_ensemble(df).columns == ["is_iso_anomaly", "is_ensemble_anomaly"]


def test_linear_attributions_add_up(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 0.0, 1.0)], "loan_id int, a double, b double")
    weights = {"a": 0.5, "b": -2.0}
    sums = attribution.linear_attributions(df, weights).groupBy("row_id").agg(F.sum("shap").alias("s")).collect()
    base = attribution.linear_base(weights, 0.1, attribution.feature_means(df, list(weights)))
    assert {r["row_id"]: r["s"] + base for r in sums} == pytest.approx({1: 0.1 + 1 - 6, 2: 0.1 - 2})


def test_report_text_and_card(spark):
    metrics = evaluation.model_comparison(scores(spark, [1, 0, 1, 0], [0.9, 0.2, 0.6, 0.4]))
    importance = spark.createDataFrame([("age", 0.5), ("debt", 0.7)], "feature string, mean_abs_shap double")
    summary = loss.portfolio_summary(loss.expected_loss(spark.createDataFrame([(0.2,)], "pd_predicted double")))
    text = reporting.report_markdown("Report", reporting.validation_rows(metrics, importance, summary).collect())
    assert "| auc_roc | 1.0000 | Excellent |" in text and "1 debt" in text
    card = reporting.model_card(metrics, importance, summary, "snapshot", "y").first()
    assert card["training_data"]["features_used"] == 2 and '"feature":"debt"' in card["card_json"]
    assert card["competing_models"] == []


def test_best_model_tie_takes_first_name(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", 0.1)], "model string, auc_roc double")
    assert evaluation.best_model(df).first()["model"] == "a"
