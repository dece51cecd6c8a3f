"""F1-F18."""

from pyspark.sql import functions as F

from lendscope import fixed_values as fx
from lendscope.operators import cleaning, features
from workload.registry import query
from workload.sources import plain, snapshot
from workload.views import view

COUNTS = ["NumberOfTime30_59DaysPastDueNotWorse", "NumberOfTimes90DaysLate", "NumberOfTime60_89DaysPastDueNotWorse"]


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _median_fill(c):
    return (f"CASE WHEN {c} IN (96, 98) THEN (SELECT quantile_cont({c}, 0.5) FROM borrowers WHERE {c} NOT IN (96, 98)) "
            f"ELSE CAST({c} AS DOUBLE) END")


CAPPED = f"capped AS (SELECT borrowers.* REPLACE ({', '.join(f'{_median_fill(c)} AS {c}' for c in COUNTS)}) FROM borrowers)"


@query("f01_coerce_numbers", """
SELECT loan_id, loan_amnt, TRY_CAST(int_rate AS DOUBLE) AS int_rate, dti, TRY_CAST(revol_util AS DOUBLE) AS revol_util FROM loans""")
def f01(spark, sf_dir):
    text = view(spark, sf_dir, "loans").select(
        "loan_id", *[F.col(c).cast("string").alias(c) for c in ("loan_amnt", "int_rate", "dti", "revol_util")])
    return features.coerce_numbers(text)


@query("f02_percent_to_number", """
SELECT loan_id, TRY_CAST(replace(int_rate, '%', '') AS DOUBLE) AS int_rate, TRY_CAST(replace(revol_util, '%', '') AS DOUBLE) AS revol_util
FROM loans""")
def f02(spark, sf_dir):
    return cleaning.percent_columns(view(spark, sf_dir, "loans").select("loan_id", "int_rate", "revol_util"))


@query("f03_replace_codes", f"WITH {CAPPED} SELECT loan_id, {', '.join(COUNTS)} FROM capped")
def f03(spark, sf_dir):
    return plain(features.replace_artifact_codes(snapshot(spark, sf_dir))).select("loan_id", *COUNTS)


@query("f04_delinquency_flags", f"""
WITH {CAPPED}
SELECT loan_id, CASE WHEN NumberOfTime30_59DaysPastDueNotWorse >= 1 THEN 1 ELSE 0 END AS flag_30dpd,
       CASE WHEN NumberOfTime60_89DaysPastDueNotWorse >= 1 THEN 1 ELSE 0 END AS flag_60dpd,
       CASE WHEN NumberOfTimes90DaysLate >= 1 THEN 1 ELSE 0 END AS flag_90dpd FROM capped""")
def f04(spark, sf_dir):
    capped = features.replace_artifact_codes(snapshot(spark, sf_dir))
    return features.delinquency_flags(capped).select("loan_id", "flag_30dpd", "flag_60dpd", "flag_90dpd")


@query("f05_delinquency_flag", """
SELECT loan_id, coalesce(delinq_2yrs, 0) AS delinq_2yrs, CASE WHEN coalesce(delinq_2yrs, 0) >= 1 THEN 1 ELSE 0 END AS flag_delinq
FROM loans""")
def f05(spark, sf_dir):
    return features.delinquency_flag(view(spark, sf_dir, "loans")).select("loan_id", "delinq_2yrs", "flag_delinq")


def _bucket(x, edges):
    a, b, c = edges
    return (f"CASE WHEN {x} <= {a} THEN 'Low' WHEN {x} <= {b} THEN 'Medium' WHEN {x} <= {c} THEN 'High' "
            f"WHEN {x} IS NOT NULL THEN 'Very High' END")


@query("f06_utilization_bucket", f"""
WITH m AS (SELECT *, RevolvingUtilizationOfUnsecuredLines *
    CASE WHEN (SELECT quantile_cont(RevolvingUtilizationOfUnsecuredLines, 0.5) FROM borrowers) < 2 THEN 100 ELSE 1 END AS pct FROM borrowers)
SELECT loan_id, {_bucket('pct', (30, 60, 90))} AS RevolvingUtilizationOfUnsecuredLines_bucket FROM m""")
def f06(spark, sf_dir):
    return features.utilization_bucket(view(spark, sf_dir, "borrowers"), fx.SNAPSHOT_UTILIZATION).select(
        "loan_id", f"{fx.SNAPSHOT_UTILIZATION}_bucket")


@query("f06_utilization_bucket_percent", f"""
WITH u AS (SELECT loan_id, TRY_CAST(replace(revol_util, '%', '') AS DOUBLE) AS x FROM loans),
m AS (SELECT *, x * CASE WHEN (SELECT quantile_cont(x, 0.5) FROM u) < 2 THEN 100 ELSE 1 END AS pct FROM u)
SELECT loan_id, {_bucket('pct', (30, 60, 90))} AS revol_util_bucket FROM m""")
def f06_percent(spark, sf_dir):
    loans = cleaning.percent_columns(view(spark, sf_dir, "loans"))
    return features.utilization_bucket(loans, "revol_util").select("loan_id", "revol_util_bucket")


@query("f07_dti_bucket", f"SELECT loan_id, dti, {_bucket('dti', (20, 35, 50))} AS dti_bucket FROM loans")
def f07(spark, sf_dir):
    return features.dti_bucket(view(spark, sf_dir, "loans")).select("loan_id", "dti", "dti_bucket")


@query("f08_bucket_distribution", f"""
SELECT bucket, count(*) AS count FROM (SELECT {_bucket('dti', (20, 35, 50))} AS bucket FROM loans) b WHERE bucket IS NOT NULL GROUP BY bucket""")
def f08(spark, sf_dir):
    return features.bucket_distribution(features.dti_bucket(view(spark, sf_dir, "loans")), "dti_bucket")


def _log(c):
    return f"round(ln(1 + CASE WHEN {c} < 0 THEN 0 ELSE {c} END), 6) AS log_{c}"


@query("f09_log_columns", f"SELECT loan_id, {', '.join(_log(c) for c in fx.SNAPSHOT_LOG_COLUMNS)} FROM borrowers")
def f09(spark, sf_dir):
    logs = [f"log_{c}" for c in fx.SNAPSHOT_LOG_COLUMNS]
    return _rounded(features.log_columns(view(spark, sf_dir, "borrowers"), fx.SNAPSHOT_LOG_COLUMNS).select("loan_id", *logs), *logs)


@query("f10_floor_age", "SELECT loan_id, CASE WHEN age < 18 THEN 18 ELSE age END AS age FROM borrowers")
def f10(spark, sf_dir):
    return features.floor_age(view(spark, sf_dir, "borrowers")).select("loan_id", "age")


SCORE = " + ".join(f"coalesce({c}, 0)" for c in COUNTS)


@query("f11_delinquency_score", f"WITH {CAPPED} SELECT loan_id, {SCORE} AS total_delinquency_score FROM capped")
def f11(spark, sf_dir):
    capped = features.replace_artifact_codes(snapshot(spark, sf_dir))
    return features.delinquency_score(capped).select("loan_id", "total_delinquency_score")


DATED = """dated AS (SELECT *, CASE WHEN issue_d = 'bad-date' THEN NULL ELSE CAST(strptime(issue_d, '%b-%Y') AS DATE) END AS issue_date FROM loans)"""


@query("f12_issue_parts", f"""
WITH {DATED} SELECT loan_id, issue_date, CAST(year(issue_date) AS INT) AS issue_year, CAST(quarter(issue_date) AS INT) AS issue_quarter FROM dated""")
def f12(spark, sf_dir):
    return features.issue_parts(view(spark, sf_dir, "loans")).select("loan_id", "issue_date", "issue_year", "issue_quarter")


@query("f13_loan_vintage", f"""
WITH {DATED}, latest AS (SELECT max(issue_date) AS d FROM dated)
SELECT loan_id, CAST((year(latest.d) - year(issue_date)) * 12 + month(latest.d) - month(issue_date) AS INT) AS loan_vintage_months
FROM dated, latest""")
def f13(spark, sf_dir):
    return features.loan_vintage(features.issue_parts(view(spark, sf_dir, "loans"))).select("loan_id", "loan_vintage_months")


EMPLOYMENT = """CAST(CASE WHEN emp_length = '< 1 year' THEN 0 WHEN emp_length = '10+ years' THEN 10
  WHEN regexp_matches(emp_length, '^[1-9] years?$') THEN CAST(substr(emp_length, 1, 1) AS INT) ELSE -1 END AS INT)"""


@query("f14_employment_years", f"SELECT loan_id, emp_length, {EMPLOYMENT} AS emp_length_years FROM loans")
def f14(spark, sf_dir):
    return features.employment_years(view(spark, sf_dir, "loans")).select("loan_id", "emp_length", "emp_length_years")


GRADE = "CAST(CASE WHEN grade BETWEEN 'A' AND 'G' THEN ascii(grade) - 64 END AS INT)"


@query("f15_grade_ordinal", f"SELECT loan_id, grade, {GRADE} AS grade_numeric FROM loans")
def f15(spark, sf_dir):
    return features.grade_ordinal(view(spark, sf_dir, "loans")).select("loan_id", "grade", "grade_numeric")


def _flag(c):
    return f"CASE WHEN {c} >= 1 THEN 1 ELSE 0 END"


@query("f16_snapshot_profile", f"""
WITH {CAPPED}
SELECT round(avg({_flag(COUNTS[0])}) * 100, 6) AS pct_flag_30dpd, round(avg({_flag(COUNTS[2])}) * 100, 6) AS pct_flag_60dpd,
       round(avg({_flag(COUNTS[1])}) * 100, 6) AS pct_flag_90dpd, round(avg({SCORE}), 6) AS mean_score, max({SCORE}) AS max_score
FROM capped""")
def f16(spark, sf_dir):
    profile = features.feature_profile(features.snapshot_features(snapshot(spark, sf_dir)))
    return _rounded(profile, "pct_flag_30dpd", "pct_flag_60dpd", "pct_flag_90dpd", "mean_score")


@query("f16_loan_profile", f"""
WITH {DATED}
SELECT round(avg(CASE WHEN delinq_2yrs >= 1 THEN 1 ELSE 0 END) * 100, 6) AS pct_flag_delinq,
       CAST(min(year(issue_date)) AS INT) AS first_year, CAST(max(year(issue_date)) AS INT) AS last_year,
       round(avg(CASE WHEN {EMPLOYMENT} >= 0 THEN {EMPLOYMENT} END), 6) AS mean_employment FROM dated""")
def f16_loans(spark, sf_dir):
    profile = features.feature_profile(features.loan_book_features(view(spark, sf_dir, "loans")))
    return _rounded(profile, "pct_flag_delinq", "mean_employment")


@query("f17_snapshot_features", f"""
WITH {CAPPED}
SELECT capped.* REPLACE (CASE WHEN age < 18 THEN 18 ELSE age END AS age),
       {_flag(COUNTS[0])} AS flag_30dpd, {_flag(COUNTS[2])} AS flag_60dpd, {_flag(COUNTS[1])} AS flag_90dpd,
       {_bucket('RevolvingUtilizationOfUnsecuredLines * 100', (30, 60, 90))} AS RevolvingUtilizationOfUnsecuredLines_bucket,
       {', '.join(_log(c) for c in fx.SNAPSHOT_LOG_COLUMNS)}, {SCORE} AS total_delinquency_score
FROM capped""")
def f17(spark, sf_dir):
    out = features.snapshot_features(snapshot(spark, sf_dir))
    return plain(_rounded(out, *[f"log_{c}" for c in fx.SNAPSHOT_LOG_COLUMNS]))


@query("f18_loan_book_features", f"""
WITH d AS (SELECT loans.* REPLACE (TRY_CAST(replace(int_rate, '%', '') AS DOUBLE) AS int_rate,
                  TRY_CAST(replace(revol_util, '%', '') AS DOUBLE) AS revol_util),
             CASE WHEN issue_d = 'bad-date' THEN NULL ELSE CAST(strptime(issue_d, '%b-%Y') AS DATE) END AS issue_date FROM loans),
latest AS (SELECT max(issue_date) AS m, quantile_cont(revol_util, 0.5) AS u FROM d)
SELECT d.* REPLACE (coalesce(delinq_2yrs, 0) AS delinq_2yrs),
       CAST(year(issue_date) AS INT) AS issue_year, CAST(quarter(issue_date) AS INT) AS issue_quarter,
       CAST((year(m) - year(issue_date)) * 12 + month(m) - month(issue_date) AS INT) AS loan_vintage_months,
       {EMPLOYMENT} AS emp_length_years, CASE WHEN coalesce(delinq_2yrs, 0) >= 1 THEN 1 ELSE 0 END AS flag_delinq,
       {_bucket('dti', (20, 35, 50))} AS dti_bucket,
       {_bucket('revol_util * CASE WHEN u < 2 THEN 100 ELSE 1 END', (30, 60, 90))} AS revol_util_bucket,
       {', '.join(_log(c) for c in fx.LOAN_LOG_COLUMNS)}, {GRADE} AS grade_numeric
FROM d, latest""")
def f18(spark, sf_dir):
    out = features.loan_book_features(cleaning.percent_columns(view(spark, sf_dir, "loans")))
    return _rounded(out, *[f"log_{c}" for c in fx.LOAN_LOG_COLUMNS])
