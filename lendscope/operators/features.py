"""Derived risk features.

Fitted values (medians, scales, latest date) are plain numbers in ``FeatureFit``. Fit on a
batch and apply to it, or apply a stored fit to another batch or to a stream.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from lendscope import fixed_values as fx
from lendscope import functions as fn
from lendscope.operators.cleaning import _c
from lendscope.operators.quantiles import exact_quantiles
from lendscope.sources.readers import string_columns


@dataclass(frozen=True)
class FeatureFit:
    """Constants taken from data: artifact replacements, percent scales, latest issue date."""

    replacements: Mapping[str, float | None] = field(default_factory=dict)
    scales: Mapping[str, float] = field(default_factory=dict)
    latest_issue: dt.date | None = None


LATE_COUNTS = (fx.LATE_30, fx.LATE_90, fx.LATE_60)
FLAGS = {"flag_30dpd": fx.LATE_30, "flag_60dpd": fx.LATE_60, "flag_90dpd": fx.LATE_90}


def _present(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in df.columns]


def coerce_numbers(df: DataFrame, columns: Sequence[str] = fx.LOAN_NUMERIC_COLUMNS) -> DataFrame:
    """Text columns are parsed; numeric ones are only widened to double."""
    text = set(string_columns(df))
    changed = {
        c: fn.to_number(_c(c)) if c in text else fn.clean_number(_c(c).cast("double")) for c in _present(df, columns)
    }
    return df.withColumns(changed) if changed else df


def _is_code(name: str):
    return _c(name).isin(*fx.ARTIFACT_CODES)


def fit_features(df: DataFrame, counts: Sequence[str] = (), utilization: str | None = None, issue_date: str | None = None) -> FeatureFit:
    """All medians of a feature set in one shared pass, and the latest issue date in another."""
    counts = _present(df, counts)
    wanted = {c: (F.when(~_is_code(c), _c(c)), 0.5) for c in counts}
    if utilization in df.columns:
        wanted["utilization of " + utilization] = (_c(utilization), 0.5)
    found = exact_quantiles(df, wanted)
    scales = {}
    if utilization in df.columns:
        middle = found["utilization of " + utilization]
        scales[utilization] = 100.0 if middle is not None and middle < fx.FRACTION_SCALE_LIMIT else 1.0
    latest = None
    if issue_date is not None and issue_date in df.columns:
        latest = df.agg(F.max(fn.month_year_to_date(_c(issue_date)))).first()[0]
    return FeatureFit({c: found[c] for c in counts}, scales, latest)


def replace_artifact_codes(df: DataFrame, fit: FeatureFit | None = None, columns: Sequence[str] = LATE_COUNTS) -> DataFrame:
    """Codes 96 and 98 become the median of the column's other values."""
    fit = fit or fit_features(df, counts=columns)
    changed = {}
    for c in _present(df, columns):
        replacement = F.lit(fit.replacements.get(c)).cast("double")
        changed[c] = F.when(_is_code(c), replacement).otherwise(_c(c).cast("double"))
    return df.withColumns(changed) if changed else df


def delinquency_flags(df: DataFrame, flags: Mapping[str, str] = FLAGS) -> DataFrame:
    added = {flag: fn.at_least(_c(c)) for flag, c in flags.items() if c in df.columns}
    return df.withColumns(added) if added else df


def delinquency_flag(df: DataFrame, column: str = "delinq_2yrs") -> DataFrame:
    if column not in df.columns:
        return df
    counted = F.coalesce(fn.to_number(_c(column)), F.lit(0.0))
    return df.withColumn(column, counted).withColumn("flag_delinq", fn.at_least(_c(column)))


def utilization_bucket(df: DataFrame, column: str, fit: FeatureFit | None = None) -> DataFrame:
    """Low to Very High utilization, with 0-1 data scaled to percent first."""
    if column not in df.columns:
        return df
    fit = fit or fit_features(df, utilization=column)
    percent = fn.clean_number(_c(column).cast("double")) * fit.scales[column]
    return df.withColumn(f"{column}_bucket", fn.right_closed_bucket(percent, fx.UTILIZATION_EDGES, fx.BUCKET_LABELS))


def dti_bucket(df: DataFrame, column: str = "dti") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn("dti_bucket", fn.right_closed_bucket(_c(column), fx.DTI_EDGES, fx.BUCKET_LABELS))


def bucket_distribution(df: DataFrame, bucket: str) -> DataFrame:
    """Rows per bucket, largest first; null is not a bucket."""
    counted = df.filter(_c(bucket).isNotNull()).groupBy(_c(bucket).alias("bucket")).count()
    return counted.orderBy(F.desc("count"), "bucket")


def log_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    added = {f"log_{c}": fn.log1p_floor0(_c(c)) for c in _present(df, columns)}
    return df.withColumns(added) if added else df


def floor_age(df: DataFrame, column: str = "age") -> DataFrame:
    return df.withColumn(column, fn.floor_at(_c(column), fx.MINIMUM_AGE)) if column in df.columns else df


def delinquency_score(df: DataFrame, columns: Sequence[str] = LATE_COUNTS) -> DataFrame:
    present = _present(df, columns)
    if not present:
        return df
    return df.withColumn("total_delinquency_score", fn.row_sum([_c(c) for c in present]))


def issue_parts(df: DataFrame, column: str = "issue_d") -> DataFrame:
    if column not in df.columns:
        return df
    dated = df.withColumn("issue_date", fn.month_year_to_date(_c(column)))
    return dated.withColumns({"issue_year": F.year("issue_date"), "issue_quarter": F.quarter("issue_date")})


def loan_vintage(df: DataFrame, latest: dt.date | None = None) -> DataFrame:
    """Months from issue to the data's latest issue date; no column when no date is known."""
    if "issue_date" not in df.columns:
        return df
    latest = latest or df.agg(F.max("issue_date")).first()[0]
    if latest is None:
        return df
    return df.withColumn("loan_vintage_months", fn.months_between_dates(F.lit(latest), F.col("issue_date")))


def employment_years(df: DataFrame, column: str = "emp_length") -> DataFrame:
    return df.withColumn("emp_length_years", fn.encode_employment(_c(column))) if column in df.columns else df


def grade_ordinal(df: DataFrame, column: str = "grade") -> DataFrame:
    return df.withColumn("grade_numeric", fn.encode_grade(_c(column))) if column in df.columns else df


def feature_profile(df: DataFrame) -> DataFrame:
    """One row: % positive per flag, score mean and max, issue year range, mean known employment."""
    out = []
    for flag in ("flag_30dpd", "flag_60dpd", "flag_90dpd", "flag_delinq"):
        if flag in df.columns:
            out.append((F.avg(flag) * 100).alias(f"pct_{flag}"))
    if "total_delinquency_score" in df.columns:
        out += [F.avg("total_delinquency_score").alias("mean_score"), F.max("total_delinquency_score").alias("max_score")]
    if "issue_year" in df.columns:
        out += [F.min("issue_year").alias("first_year"), F.max("issue_year").alias("last_year")]
    if "emp_length_years" in df.columns:
        known = F.when(F.col("emp_length_years") >= 0, F.col("emp_length_years"))
        out.append(F.avg(known).alias("mean_employment"))
    return df.agg(*out)


def fit_snapshot(df: DataFrame, counts: Sequence[str] = LATE_COUNTS) -> FeatureFit:
    return fit_features(df, counts=counts, utilization=fx.SNAPSHOT_UTILIZATION)


def snapshot_features(
    df: DataFrame,
    fit: FeatureFit | None = None,
    counts: Sequence[str] = LATE_COUNTS,
    flags: Mapping[str, str] = FLAGS,
) -> DataFrame:
    """F3, F4, F6, F9, F10, F11 in this order, as one projection over the input."""
    fit = fit or fit_snapshot(df, counts)
    return (
        df.transform(replace_artifact_codes, fit, counts)
        .transform(delinquency_flags, flags)
        .transform(utilization_bucket, fx.SNAPSHOT_UTILIZATION, fit)
        .transform(log_columns, fx.SNAPSHOT_LOG_COLUMNS)
        .transform(floor_age)
        .transform(delinquency_score, counts)
    )


def fit_loan_book(df: DataFrame) -> FeatureFit:
    return fit_features(coerce_numbers(df), utilization="revol_util", issue_date="issue_d")


def loan_book_features(df: DataFrame, fit: FeatureFit | None = None) -> DataFrame:
    """F1, F12, F13, F14, F5, F7, F6, F9, F15 in this order, as one projection over the input."""
    fit = fit or fit_loan_book(df)
    out = df.transform(coerce_numbers).transform(issue_parts)
    if fit.latest_issue is not None:
        out = out.transform(loan_vintage, fit.latest_issue)
    return (
        out.transform(employment_years)
        .transform(delinquency_flag)
        .transform(dti_bucket)
        .transform(utilization_bucket, "revol_util", fit)
        .transform(log_columns, fx.LOAN_LOG_COLUMNS)
        .transform(grade_ordinal)
    )
