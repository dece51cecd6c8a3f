"""C1-C13."""

from pyspark.sql import functions as F

from lendscope import fixed_values as fx
from lendscope.operators import cleaning
from workload.registry import query
from workload.sources import plain, snapshot
from workload.views import view

TARGET = fx.SNAPSHOT_TARGET
CONTENT = """SeriousDlqin2yrs, RevolvingUtilizationOfUnsecuredLines, age, NumberOfTime30_59DaysPastDueNotWorse, DebtRatio,
       MonthlyIncome, NumberOfOpenCreditLinesAndLoans, NumberOfTimes90DaysLate, NumberRealEstateLoansOrLines,
       NumberOfTime60_89DaysPastDueNotWorse, NumberOfDependents"""
CONTENT_COLUMNS = [c.strip() for c in CONTENT.split(",")]
NUMBERS = ["loan_id", *CONTENT_COLUMNS]
FEATURES = [c for c in CONTENT_COLUMNS if c != "SeriousDlqin2yrs"]


@query("c01_drop_null_target", "SELECT * FROM borrowers WHERE SeriousDlqin2yrs IS NOT NULL")
def c01(spark, sf_dir):
    return plain(cleaning.drop_null_target(snapshot(spark, sf_dir), TARGET))


@query("c02_distinct_rows", """
SELECT DISTINCT term, grade, sub_grade, emp_length, home_ownership, verification_status, purpose, addr_state FROM loans""")
def c02(spark, sf_dir):
    terms = view(spark, sf_dir, "loans").select(
        "term", "grade", "sub_grade", "emp_length", "home_ownership", "verification_status", "purpose", "addr_state")
    return cleaning.drop_duplicate_rows(terms)


@query("c03_dedup_ignore_id", f"SELECT min(loan_id) AS loan_id, {CONTENT} FROM borrowers GROUP BY {CONTENT}")
def c03(spark, sf_dir):
    return plain(cleaning.drop_duplicate_rows(snapshot(spark, sf_dir), "loan_id"))


@query("c04_null_counts", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS null_count FROM borrowers""" for c in NUMBERS))
def c04(spark, sf_dir):
    return cleaning.null_counts(view(spark, sf_dir, "borrowers"))


_WHOLE = {"age", "NumberOfTime30_59DaysPastDueNotWorse", "NumberOfOpenCreditLinesAndLoans", "NumberOfTimes90DaysLate",
          "NumberRealEstateLoansOrLines", "NumberOfTime60_89DaysPastDueNotWorse"}


def _filled(c):
    median = f"(SELECT quantile_cont({c}, 0.5) FROM d)"
    return f"coalesce({c}, CAST(trunc({median}) AS INT)) AS {c}" if c in _WHOLE else f"coalesce({c}, {median}) AS {c}"


@query("c05_impute_exact_median", f"""
WITH d AS (SELECT min(loan_id) AS loan_id, {CONTENT} FROM borrowers WHERE SeriousDlqin2yrs IS NOT NULL GROUP BY {CONTENT})
SELECT loan_id, SeriousDlqin2yrs, {', '.join(_filled(c) for c in FEATURES)} FROM d""")
def c05(spark, sf_dir):
    return plain(cleaning.clean(snapshot(spark, sf_dir), TARGET, "loan_id", method="exact"))


@query("c05_impute_approx_median")
def c05_approx(spark, sf_dir):
    return plain(cleaning.clean(snapshot(spark, sf_dir), TARGET, "loan_id", method="approx"))


ROW_FLOW = f"""
WITH g AS (SELECT {CONTENT}, count(*) AS copies FROM borrowers GROUP BY {CONTENT}),
f AS (SELECT CAST(sum(copies) AS BIGINT) AS initial_rows,
       CAST(sum(CASE WHEN SeriousDlqin2yrs IS NOT NULL THEN copies ELSE 0 END) AS BIGINT) AS labelled_rows,
       CAST(sum(CASE WHEN SeriousDlqin2yrs IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS final_rows FROM g)
SELECT initial_rows, labelled_rows, initial_rows - labelled_rows AS dropped_null_target,
       labelled_rows - final_rows AS dropped_duplicates, final_rows,
       round(final_rows * 100.0::DOUBLE / initial_rows, 6) AS pct_retained FROM f"""


@query("c06_row_flow", ROW_FLOW)
def c06(spark, sf_dir):
    flow = cleaning.row_flow(snapshot(spark, sf_dir), TARGET, "loan_id")
    return flow.withColumn("pct_retained", F.round("pct_retained", 6))


@query("c07_keep_labelled", "SELECT * FROM loans WHERE loan_status IN ('Charged Off', 'Default', 'Fully Paid')")
def c07(spark, sf_dir):
    return cleaning.keep_labelled(view(spark, sf_dir, "loans"))


@query("c08_encode_target", """
SELECT loan_id, loan_status, CASE WHEN loan_status IN ('Charged Off', 'Default') THEN 1 ELSE 0 END AS is_default
FROM loans WHERE loan_status IN ('Charged Off', 'Default', 'Fully Paid')""")
def c08(spark, sf_dir):
    return cleaning.encode_target(cleaning.keep_labelled(view(spark, sf_dir, "loans"))).select("loan_id", "loan_status", "is_default")


@query("c09_rename_id", "SELECT * FROM borrowers")
def c09(spark, sf_dir):
    return cleaning.rename_id(view(spark, sf_dir, "borrowers").withColumnRenamed("loan_id", "row_id"))


@query("c10_numeric_features", f"SELECT {', '.join(FEATURES)} FROM borrowers")
def c10(spark, sf_dir):
    df = view(spark, sf_dir, "borrowers")
    return df.select(*cleaning.feature_columns(df, TARGET))


@query("c11_fill_medians", f"""
WITH t AS (SELECT * FROM borrowers WHERE SeriousDlqin2yrs IS NOT NULL)
SELECT loan_id, SeriousDlqin2yrs,
       {', '.join(f'CAST(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM t)) AS DOUBLE) AS {c}' for c in FEATURES)}
FROM t""")
def c11(spark, sf_dir):
    return cleaning.feature_matrix(cleaning.drop_null_target(view(spark, sf_dir, "borrowers"), TARGET), TARGET, "loan_id")


@query("c12_class_balance", """
SELECT round(avg(SeriousDlqin2yrs) * 100, 6) AS pct_default, round(100.0::DOUBLE - avg(SeriousDlqin2yrs) * 100, 6) AS pct_non_default
FROM borrowers""")
def c12(spark, sf_dir):
    return cleaning.class_balance(view(spark, sf_dir, "borrowers"), TARGET).select(
        F.round("pct_default", 6).alias("pct_default"), F.round("pct_non_default", 6).alias("pct_non_default"))


@query("c13_healthy_only", "SELECT * FROM borrowers WHERE SeriousDlqin2yrs = 0")
def c13(spark, sf_dir):
    return cleaning.healthy_only(view(spark, sf_dir, "borrowers"), TARGET)
