"""Fitted models, checked by rows and properties."""

from functools import lru_cache

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lendscope import fixed_values as fx
from lendscope.operators import attribution, cleaning, isolation, oversampling, reconstruction, sampling
from lendscope.operators.shared_storage import cut_lineage, join_large, scratch_path
from lendscope.plans import ingestion, sequence_run, training
from lendscope.sources import sinks
from workload.registry import query
from workload.sequences import FEATURES, LENGTH, ORDER
from workload.sources import snapshot
from workload.views import view

TARGET = fx.SNAPSHOT_TARGET
MACRO_QUARTER = (1999, 4)


def feature_table(spark, sf_dir):
    """The snapshot feature store, written once per session and scale folder."""
    return _feature_table(spark, sf_dir)


@lru_cache(maxsize=4)
def _feature_table(spark, sf_dir):
    raw = snapshot(spark, sf_dir).withColumnRenamed("loan_id", "row_id")
    return cut_lineage(ingestion.snapshot_table(raw, view(spark, sf_dir, "macro_q"), quarter=MACRO_QUARTER))


@lru_cache(maxsize=4)
def prepared(spark, sf_dir):
    return training.prepare(feature_table(spark, sf_dir), TARGET)


_fitted = {}


@lru_cache(maxsize=16)
def trained(spark, sf_dir, name):
    model = training.train_model(name, prepared(spark, sf_dir))
    _fitted.setdefault((spark, sf_dir), []).append(model)
    return model


def trained_all(spark, sf_dir):
    """All models; those that no query has fitted yet are fitted side by side."""
    prepared(spark, sf_dir)
    return training.side_by_side(spark, lambda name: trained(spark, sf_dir, name), training.MODELS)


def fitted_models(spark, sf_dir):
    """Models that queries have fitted so far."""
    return _fitted.get((spark, sf_dir), [])


@lru_cache(maxsize=4)
def matrix(spark, sf_dir):
    """Numeric features of every labelled borrower, gaps filled."""
    return cut_lineage(cleaning.feature_matrix(feature_table(spark, sf_dir), TARGET, "loan_id"))


def _features(rows):
    return cleaning.feature_columns(rows, TARGET)


def _scores(name):
    def build(spark, sf_dir):
        scored = training.score(trained(spark, sf_dir, name).model, prepared(spark, sf_dir).test)
        return scored.select("loan_id", "label", "score", "predicted")

    return build


for _entry, _name in zip(("m01_logistic_regression", "m02_random_forest", "m03_gradient_boosting", "m04_balanced_boosting"),
                         training.MODELS, strict=True):
    query(_entry)(_scores(_name))


@query("m05_train_all")
def m05(spark, sf_dir):
    """Training seconds and boosting rounds per model."""
    runs = trained_all(spark, sf_dir)
    return spark.createDataFrame([(t.name, float(t.seconds), t.rounds) for t in runs.values()], "model string, seconds double, rounds int")


@query("m06_score_all")
def m06(spark, sf_dir):
    """Scores of all models over the whole labelled portfolio, not only the test split."""
    data = prepared(spark, sf_dir)
    everyone = sampling.scale(matrix(spark, sf_dir).withColumnRenamed(TARGET, "label"), data.scaler)
    return training.score_all(trained_all(spark, sf_dir), everyone)


@query("p04_synthetic_minority")
def p04(spark, sf_dir):
    """Synthetic rows of the training split, scaled by that split."""
    data = training.prepare(feature_table(spark, sf_dir), TARGET, balance=False)
    made = oversampling.synthetic_minority(data.train, data.features, training.LABEL)
    return made.select(F.col(training.LABEL).alias(TARGET), "base_key", *data.features)


@query("s14_model_round_trip")
def s14(spark, sf_dir):
    """Scores by a stored and reloaded pipeline of unscaled features, next to those of the fitted model on scaled ones."""
    fitted, data = trained(spark, sf_dir, "Logistic Regression"), prepared(spark, sf_dir)
    path = sinks.save_model(training.scoring_pipeline(fitted, data), scratch_path(spark, "model"))
    raw = feature_table(spark, sf_dir).select("loan_id", *data.features)
    again = training.score(PipelineModel.load(path), raw).select("loan_id", F.col("score").alias("reloaded"))
    return join_large(training.score(fitted.model, data.test).select("loan_id", "score"), again, "loan_id")


@query("x02_tree_attributions")
def x02(spark, sf_dir):
    return training.explain(trained(spark, sf_dir, "Random Forest"), prepared(spark, sf_dir))


@query("x02_boosted_attributions")
def x02_boosted(spark, sf_dir):
    return training.explain(trained(spark, sf_dir, "Gradient Boosting"), prepared(spark, sf_dir))


@query("x06_beeswarm")
def x06(spark, sf_dir):
    return training.explain(trained(spark, sf_dir, "Logistic Regression"), prepared(spark, sf_dir))


@query("x07_builtin_importance")
def x07(spark, sf_dir):
    data = prepared(spark, sf_dir)
    frames = [
        attribution.builtin_importance(spark, trained(spark, sf_dir, name).classifier, data.features).withColumn("model", F.lit(name))
        for name in training.MODELS[:2]
    ]
    return frames[0].unionByName(frames[1])


@query("a01_isolation_score")
def a01(spark, sf_dir):
    rows = matrix(spark, sf_dir)
    forest = isolation.fit_isolation_forest(cleaning.healthy_only(rows, TARGET), _features(rows))
    return isolation.score_isolation(rows, forest).select("loan_id", "iso_forest_score")


@query("a03_reconstruction_error")
def a03(spark, sf_dir):
    rows = matrix(spark, sf_dir)
    bottleneck = reconstruction.fit_bottleneck(cleaning.healthy_only(rows, TARGET), _features(rows))
    return reconstruction.score_reconstruction(rows, bottleneck).select("loan_id", "reconstruction_error")


@query("q04_sequence_classifier")
def q04(spark, sf_dir):
    return sequence_run.sequence_run(view(spark, sf_dir, "perf"), "loan_seq_num", ORDER, FEATURES, LENGTH)
