"""Data overview and feature histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendscope import fixed_values as fx
from lendscope.operators.cleaning import _c
from lendscope.operators.histograms import histogram
from lendscope.operators.sampling import hash_sample

FEATURE_BINS = 60


def overview(df: DataFrame, target: str) -> DataFrame:
    """Rows, columns, default rate and mean share of missing cells, in one pass."""
    missing = sum((F.avg(_c(c).isNull().cast("int")) for c in df.columns[1:]), F.avg(_c(df.columns[0]).isNull().cast("int")))
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(df.columns)).alias("total_columns"),
        (F.avg(_c(target)) * 100).alias("default_rate_pct"),
        (missing / len(df.columns) * 100).alias("missing_pct"),
    )


def feature_histogram(df: DataFrame, feature: str, target: str, id_column: str = "loan_id",
                      sample: int | None = None, bins: int = FEATURE_BINS) -> DataFrame:
    """Histogram per label over the complete rows, or over a repeatable sample of them."""
    complete = df.select(_c(id_column), _c(feature), _c(target)).dropna()
    return histogram(hash_sample(complete, sample, id_column) if sample else complete, feature, bins, by=target)
