"""Literal cases of the feature rules."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from lendscope import fixed_values as fx
from lendscope import functions as fn
from lendscope.operators import cleaning, features


def column(df, name):
    return [r[name] for r in df.orderBy("n").select(name).collect()]


def frame(spark, **columns):
    names = list(columns)
    kinds = {int: "int", float: "double", str: "string"}
    types = [kinds[type(next(v for v in columns[c] if v is not None))] for c in names]
    rows = [(i, *values) for i, values in enumerate(zip(*columns.values(), strict=True))]
    return spark.createDataFrame(rows, "n int, " + ", ".join(f"`{c}` {t}" for c, t in zip(names, types, strict=True)))


COUNTS = {fx.LATE_30: [5, 0, 0], fx.LATE_60: [0, 7, 0], fx.LATE_90: [1, 1, 0]}


def test_flags(spark):
    out = features.delinquency_flags(frame(spark, **COUNTS))
    for name, flag in ((fx.LATE_30, "flag_30dpd"), (fx.LATE_60, "flag_60dpd"), (fx.LATE_90, "flag_90dpd")):
        assert column(out, flag) == [min(n, 1) for n in COUNTS[name]]


def test_flag_of_null_is_zero(spark):
    assert column(features.delinquency_flags(frame(spark, **{fx.LATE_30: [None, 2]})), "flag_30dpd") == [0, 1]


def test_artifact_codes_take_the_median_of_the_rest(spark):
    out = features.replace_artifact_codes(frame(spark, **{fx.LATE_30: [98, 4, 95, 6, 96, 10], fx.LATE_60: [3, 3, 97, 3, 3, 3]}))
    assert column(out, fx.LATE_30) == [8.0, 4.0, 95.0, 6.0, 8.0, 10.0]
    assert column(out, fx.LATE_60) == [3.0, 3.0, 97.0, 3.0, 3.0, 3.0]


def test_only_artifact_codes_leave_null(spark):
    assert column(features.replace_artifact_codes(frame(spark, **{fx.LATE_30: [96, 98]})), fx.LATE_30) == [None, None]


def test_log_columns(spark):
    out = features.log_columns(frame(spark, MonthlyIncome=[None, 6, -1, 0]), ["MonthlyIncome", "absent"])
    logs = column(out, "log_MonthlyIncome")
    assert logs[2:] == [0.0, 0.0] and logs[1] == pytest.approx(math.log(7)) and logs[0] is None
    assert "log_absent" not in out.columns


def test_utilization_buckets_and_edges(spark):
    out = features.utilization_bucket(frame(spark, revol_util=[None, 0.0, 30.0, 30.01, 60.0, 60.01, 90.0, 90.01, 140.0]), "revol_util")
    assert column(out, "revol_util_bucket") == [None, "Low", "Low", "Medium", "Medium", "High", "High", "Very High", "Very High"]


def test_utilization_scale_is_detected(spark):
    out = features.utilization_bucket(frame(spark, **{fx.SNAPSHOT_UTILIZATION: [0.3, 0.31, 0.9, 0.91, 1.4]}), fx.SNAPSHOT_UTILIZATION)
    assert column(out, f"{fx.SNAPSHOT_UTILIZATION}_bucket") == ["Low", "Medium", "High", "Very High", "Very High"]


def test_dti_buckets(spark):
    out = features.dti_bucket(frame(spark, dti=[20.0, 20.5, 35.0, 35.5, 50.0, 50.5, 0.0, None]))
    assert column(out, "dti_bucket") == ["Low", "Medium", "Medium", "High", "High", "Very High", "Low", None]


def test_age_floor(spark):
    assert column(features.floor_age(frame(spark, age=[None, 17, 18, 19, -3])), "age") == [None, 18, 18, 19, 18]


def test_score_skips_nulls(spark):
    out = features.delinquency_score(frame(spark, **{fx.LATE_30: [None, 9, 5], fx.LATE_60: [8, None, 6], fx.LATE_90: [7, 2, 4]}))
    assert column(out, "total_delinquency_score") == [15.0, 11.0, 15.0]


def test_encodings(spark):
    out = features.employment_years(frame(spark, emp_length=["n/a", "10+ years", "1 year", "9 years", "< 1 year", None]))
    assert column(out, "emp_length_years") == [-1, 10, 1, 9, 0, -1]
    assert column(features.grade_ordinal(frame(spark, grade=[*"GFEDBX", None])), "grade_numeric") == [7, 6, 5, 4, 2, None, None]


def test_issue_date_and_vintage(spark):
    out = features.loan_vintage(features.issue_parts(frame(spark, issue_d=["Dec-2011", "Jan-2012", "bad", None])))
    assert column(out, "issue_date") == [dt.date(2011, 12, 1), dt.date(2012, 1, 1), None, None]
    assert column(out, "issue_quarter") == [4, 1, None, None]
    assert column(out, "loan_vintage_months") == [1, 0, None, None]


def test_no_vintage_without_dates(spark):
    assert "loan_vintage_months" not in features.loan_vintage(features.issue_parts(frame(spark, issue_d=["x", "y"]))).columns


def test_numbers_from_text(spark):
    df = frame(spark, x=["12", " 1.5 ", "1e3", "1d", "2F", "n/a", "13.56%", "NaN", None])
    assert column(df.withColumn("y", fn.to_number("x")), "y") == [12.0, 1.5, 1000.0, None, None, None, None, None, None]
    assert column(df.withColumn("y", fn.percent_to_number("x")), "y")[6] == 13.56


def test_risk_grades(spark):
    df = frame(spark, p=[0.0, 0.02, 0.05, 0.08, 0.1, 0.15, 0.2, 0.35, 0.5, 0.8, 1.0, 1.5, -0.1, None])
    grades = [g and g[0] for g in column(df.withColumn("g", fn.risk_grade("p")), "g")]
    assert grades == ["A", "A", "A", "B", "B", "C", "C", "D", "D", "E", "E", None, None, None]


def test_missing_columns_are_left_alone(spark):
    df = frame(spark, other=[1, 2])
    assert features.snapshot_features(df).columns == df.columns
    assert features.loan_book_features(df).columns == df.columns


def test_full_snapshot(spark):
    df = frame(spark, **{
        fx.SNAPSHOT_TARGET: [1, 0, 0], fx.SNAPSHOT_UTILIZATION: [0.7, 0.2, 0.4], "age": [3, 71, 52],
        fx.LATE_30: [96, 2, 4], "DebtRatio": [1.5, 0.7, 0.0], "MonthlyIncome": [None, 820.5, 64.0],
        fx.LATE_90: [1, 98, 0], fx.LATE_60: [0, 6, 96],
    })
    out = features.snapshot_features(df)
    assert min(column(out, "age")) == 18 and max(column(out, fx.LATE_30)) < 96
    for name in ("flag_30dpd", f"{fx.SNAPSHOT_UTILIZATION}_bucket", "log_DebtRatio", "total_delinquency_score"):
        assert name in out.columns


def test_empty_frame(spark):
    empty = frame(spark, **COUNTS).limit(0)
    assert features.snapshot_features(empty).count() == 0
    assert cleaning.null_counts(empty).count() == 4


def test_imputation_truncates_in_whole_columns(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (2, 2, None), (3, None, 4.0), (None, 5, 6.0)], "y int, i int, d double")
    out = cleaning.impute_medians(df, "y", method="exact")
    assert [tuple(r) for r in out.orderBy(F.col("y").asc_nulls_last()).collect()] == [
        (1, 1, 1.0), (2, 2, 4.0), (3, 2, 4.0), (None, 5, 6.0)]


def test_fill_ignores_infinities(spark):
    df = spark.createDataFrame([(0, 1.0), (1, float("inf")), (0, float("nan")), (1, 3.0)], "y int, x double")
    assert sorted(r["x"] for r in cleaning.feature_matrix(df, "y").collect()) == [1.0, 2.0, 2.0, 3.0]


def test_duplicates_keep_smallest_id(spark):
    df = spark.createDataFrame([(3, 1, None), (1, 1, None), (2, 2, 5)], "loan_id int, a int, b int")
    assert sorted(r["loan_id"] for r in cleaning.drop_duplicate_rows(df, "loan_id").collect()) == [1, 2]
