"""Flags, audits and curves over anomaly scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendscope import fixed_values as fx
from lendscope.operators.histograms import histogram
from lendscope.operators.quantiles import exact_quantiles

RATIO_FLOOR = 0.001
ERROR_BINS = 50


def score_cutoff(df: DataFrame, column: str, contamination: float = fx.CONTAMINATION) -> float | None:
    """Exact (1 - contamination) quantile with linear interpolation."""
    return exact_quantiles(df, {"cut": (F.col(column), 1 - contamination)})["cut"]


def flag_isolation(df: DataFrame, training_scores: DataFrame, contamination: float = fx.CONTAMINATION,
                   score: str = "iso_forest_score") -> DataFrame:
    """Score beyond the quantile of the training scores."""
    cut = score_cutoff(training_scores, score, contamination)
    return df.withColumn("is_iso_anomaly", F.col(score) > F.lit(cut))


def flag_reconstruction(df: DataFrame, contamination: float = fx.CONTAMINATION, error: str = "reconstruction_error") -> DataFrame:
    """Error beyond the quantile of the scored batch itself."""
    cut = score_cutoff(df, error, contamination)
    return df.withColumn("is_ae_anomaly", F.col(error) > F.lit(cut))


def flag_ensemble(df: DataFrame) -> DataFrame:
    """Any flag, and both flags; without a reconstruction flag only the isolation flag counts."""
    if "is_ae_anomaly" not in df.columns:
        return df.withColumn("is_ensemble_anomaly", F.col("is_iso_anomaly"))
    either, both = F.col("is_iso_anomaly") | F.col("is_ae_anomaly"), F.col("is_iso_anomaly") & F.col("is_ae_anomaly")
    return df.withColumns({"is_ensemble_anomaly": either, "strong_anomaly_flag": both})


def anomaly_audit(df: DataFrame, label: str = "label") -> DataFrame:
    """Flag counts, default rate of strong anomalies and of the rest, and their ratio."""
    strong = F.col("strong_anomaly_flag")
    counted = df.agg(
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if("is_iso_anomaly").alias("iso_anomalies"),
        F.count_if("is_ae_anomaly").alias("ae_anomalies"),
        F.count_if(strong).alias("strong_anomalies"),
        (F.avg(F.when(strong, F.col(label))) * 100).alias("anomaly_default_rate"),
        (F.avg(F.when(~strong, F.col(label))) * 100).alias("normal_default_rate"),
    )
    ratio = F.col("anomaly_default_rate") / F.greatest(F.col("normal_default_rate"), F.lit(RATIO_FLOOR))
    return counted.withColumn("rate_ratio", ratio)


def error_histogram(df: DataFrame, label: str = "label", error: str = "reconstruction_error") -> DataFrame:
    """Density of log(1 + error) per label, each over its own range."""
    logged = df.select(F.col(label), F.log1p(error).alias("log_error"))
    return histogram(logged, "log_error", ERROR_BINS, by=label, own_range=True, density=True)


def error_cutoff(df: DataFrame, error: str = "reconstruction_error", contamination: float = fx.CONTAMINATION) -> DataFrame:
    """The cutoff and its log form as one row."""
    cut = score_cutoff(df, error, contamination)
    return df.sparkSession.range(1).select(F.lit(cut).cast("double").alias("cutoff")).withColumn("log_cutoff", F.log1p("cutoff"))


def attach_scores(features: DataFrame, scores: DataFrame, id_column: str = "loan_id") -> DataFrame:
    """Feature rows with their anomaly columns (J7), matched by id."""
    return features.join(scores, id_column)


def labels_for(labels: DataFrame, sample: DataFrame, id_column: str = "loan_id") -> DataFrame:
    """Label rows of the sampled ids."""
    return labels.join(sample.select(id_column), id_column, "left_semi")
