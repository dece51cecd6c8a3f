"""Feature attributions in long form (row_id, feature, value, shap) and summaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window, functions as F

from lendscope.operators.cleaning import _c


def linear_attributions(df: DataFrame, coefficients: Mapping[str, float], id_column: str = "loan_id",
                        means: Mapping[str, float] | None = None) -> DataFrame:
    """Log-odds attributions of a linear model: coefficient x (value - mean)."""
    features = list(coefficients)
    if means is None:
        means = feature_means(df, features)
    entries = [
        F.struct(
            F.lit(f).alias("feature"), _c(f).cast("double").alias("value"),
            (F.lit(float(coefficients[f])) * (_c(f).cast("double") - F.lit(means[f]).cast("double"))).alias("shap"),
        )
        for f in features
    ]
    return df.select(_c(id_column).alias("row_id"), F.inline(F.array(*entries)))


def feature_means(df: DataFrame, features) -> dict[str, float]:
    row = df.agg(*[F.avg(_c(f)).alias(f"m{i}") for i, f in enumerate(features)]).first()
    return {f: row[f"m{i}"] for i, f in enumerate(features)}


def linear_base(coefficients: Mapping[str, float], intercept: float, means: Mapping[str, float]) -> float:
    """Prediction at the feature means, in log-odds."""
    return intercept + sum(coefficients[f] * means[f] for f in coefficients)


def global_importance(attributions: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    mean = attributions.groupBy("feature").agg(F.avg(F.abs("shap")).alias("mean_abs_shap"))
    return mean.orderBy(F.desc("mean_abs_shap"), "feature")


def top_features(importance: DataFrame, n: int = 15, value: str = "mean_abs_shap") -> DataFrame:
    """The first ``n`` features with their rank; one row per feature comes in."""
    ranking = Window.partitionBy(F.lit(0)).orderBy(F.desc(value), "feature")
    ranked = importance.withColumn("rank", F.row_number().over(ranking))
    return ranked.filter(F.col("rank") <= n).select("rank", "feature", value)


def explain_row(attributions: DataFrame, row_id: int, base_value: float = 0.0) -> DataFrame:
    """Waterfall data of one row: attributions by size with the running prediction."""
    one = attributions.filter(F.col("row_id") == row_id)
    by_size = Window.partitionBy("row_id").orderBy(F.desc(F.abs("shap")), "feature")
    upto = by_size.rowsBetween(Window.unboundedPreceding, 0)
    return one.select(
        "row_id", F.row_number().over(by_size).alias("rank"), "feature", "value", "shap",
        F.lit(float(base_value)).alias("base_value"), (F.sum("shap").over(upto) + F.lit(float(base_value))).alias("running"),
    )


def builtin_importance(spark, model, features) -> DataFrame:
    """Importances of a fitted tree ensemble, or absolute coefficients of a linear model."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = abs(model.coefficients.toArray())
    rows = sorted(zip(features, map(float, values), strict=True), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")
