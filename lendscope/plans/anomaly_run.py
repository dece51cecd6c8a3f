"""Anomaly run: features to flags and audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendscope import fixed_values as fx
from lendscope.operators import anomalies, cleaning, isolation, reconstruction, sampling
from lendscope.operators.shared_storage import cut_lineage


def score_anomalies(matrix: DataFrame, target: str, id_column: str = "loan_id",
                    train_rows: int | None = None, contamination: float = fx.CONTAMINATION) -> DataFrame:
    """Both scores and all flags for every row; both detectors are fitted on all healthy rows, or on ``train_rows`` of them."""
    features = [c for c in matrix.columns if c not in (id_column, target)]
    healthy = cleaning.healthy_only(matrix, target)
    train = cut_lineage(sampling.hash_sample(healthy, train_rows, id_column) if train_rows else healthy)
    bottleneck = reconstruction.fit_bottleneck(train, features)
    forest = isolation.fit_isolation_forest(train, features, id_column)
    scored = matrix.transform(isolation.score_isolation, forest).transform(reconstruction.score_reconstruction, bottleneck)
    scored = cut_lineage(scored.withColumnRenamed(target, "label"))
    flagged = anomalies.flag_isolation(scored, isolation.score_isolation(train, forest), contamination)
    return anomalies.flag_ensemble(anomalies.flag_reconstruction(flagged, contamination))


def anomaly_table(table: DataFrame, target: str, id_column: str = "loan_id", **options) -> DataFrame:
    labelled = cleaning.drop_null_target(table, target)
    return score_anomalies(cleaning.feature_matrix(labelled, target, id_column), target, id_column, **options)


def anomaly_columns(flagged: DataFrame, id_column: str = "loan_id") -> DataFrame:
    return flagged.select(F.col(id_column), "label", "iso_forest_score", "reconstruction_error", "is_iso_anomaly",
                          "is_ae_anomaly", "is_ensemble_anomaly", "strong_anomaly_flag")
