"""S1-S15."""

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lendscope import fixed_values as fx
from lendscope.operators.features import loan_book_features
from lendscope.operators.macro import enrich_with_macro
from lendscope.operators.shared_storage import scratch_path
from lendscope.sources import readers, schemas, sinks
from workload.registry import query
from workload.views import view

SNAPSHOT_RENAMES = {
    "NumberOfTime30_59DaysPastDueNotWorse": fx.LATE_30,
    "NumberOfTime60_89DaysPastDueNotWorse": fx.LATE_60,
}
SNAPSHOT_BACK = {new: old for old, new in SNAPSHOT_RENAMES.items()}


def snapshot(spark, sf_dir):
    """The borrower view under the snapshot's column names."""
    return view(spark, sf_dir, "borrowers").withColumnsRenamed(SNAPSHOT_RENAMES)


def plain(df):
    """Back to column names without hyphens."""
    return df.withColumnsRenamed(SNAPSHOT_BACK)


def star_source(spark, sf_dir):
    """Loan features with macro columns, the input of the star tables."""
    return enrich_with_macro(loan_book_features(view(spark, sf_dir, "loans")), view(spark, sf_dir, "macro_q"))


def _csv_copy(spark, df, name):
    path = scratch_path(spark, name)
    df.write.option("header", True).csv(path)
    return path


@query("s01_csv_declared_schema", """
SELECT CAST(loan_id AS INT) AS row_id, SeriousDlqin2yrs, RevolvingUtilizationOfUnsecuredLines, age,
       NumberOfTime30_59DaysPastDueNotWorse, DebtRatio, MonthlyIncome, NumberOfOpenCreditLinesAndLoans,
       NumberOfTimes90DaysLate, NumberRealEstateLoansOrLines, NumberOfTime60_89DaysPastDueNotWorse, NumberOfDependents
FROM borrowers_base""")
def s01(spark, sf_dir):
    base = view(spark, sf_dir, "borrowers_base").withColumnsRenamed(SNAPSHOT_RENAMES)
    ordered = base.withColumnRenamed("loan_id", "row_id").select(*schemas.snapshot_column_names())
    path = _csv_copy(spark, ordered, "snapshot-csv")
    return plain(readers.read_csv(spark, path, schemas.snapshot_schema()))


@query("s02_csv_text_coerced", """
SELECT CAST(loan_id AS VARCHAR) AS loan_id, loan_amnt, TRY_CAST(replace(int_rate, '%', '') AS DOUBLE) AS int_rate,
       grade, annual_inc, dti, revol_bal
FROM loans""")
def s02(spark, sf_dir):
    loans = view(spark, sf_dir, "loans").select("loan_id", "loan_amnt", F.regexp_replace("int_rate", "%", "").alias("int_rate"),
                                                "grade", "annual_inc", "dti", "revol_bal")
    return readers.read_csv_as_numbers(spark, _csv_copy(spark, loans, "loans-csv"), fx.LOAN_NUMERIC_COLUMNS)


@query("s02_csv_inferred", """
SELECT CAST(loan_id AS INT) AS loan_id, loan_amnt, grade, annual_inc, loan_status FROM loans""")
def s02_inferred(spark, sf_dir):
    loans = view(spark, sf_dir, "loans").select("loan_id", "loan_amnt", "grade", "annual_inc", "loan_status")
    return readers.read_csv(spark, _csv_copy(spark, loans, "loans-csv"), inferSchema=True)


_LOAN_VIEW = ("loan_amnt", "funded_amnt", "term", "int_rate", "installment", "grade", "sub_grade", "emp_length", "home_ownership",
              "annual_inc", "verification_status", "issue_d", "loan_status", "purpose", "addr_state", "dti", "delinq_2yrs",
              "open_acc", "pub_rec", "revol_bal", "revol_util", "total_acc")


@query("s03_declared_schemas", " UNION ALL ".join(
    f"""SELECT '{n}' AS "column", CAST({i} AS INT) AS position, '{t}' AS type, {f'count({n})' if n in _LOAN_VIEW else 'count(*) * 0'} AS fitting FROM loans"""
    for i, (n, t) in enumerate(fx.LOAN_BOOK_FIELDS)))
def s03(spark, sf_dir):
    return schemas.conformity(view(spark, sf_dir, "loans"), schemas.loan_book_schema())


@query("s04_missing_path", "SELECT count(*) AS rows, 'PATH_NOT_FOUND' AS condition FROM loans")
def s04(spark, sf_dir):
    """The condition Spark reports for a file that is not there, beside the rows of one that is."""
    present = view(spark, sf_dir, "loans").agg(F.count(F.lit(1)).alias("rows"))
    try:
        spark.read.parquet(f"{sf_dir}/no_such_table.parquet")
        condition = "none"
    except AnalysisException as e:
        condition = e.getCondition()
    return present.withColumn("condition", F.lit(condition))


@query("s05_column_contract", """
SELECT loan_amnt, int_rate, annual_inc, dti, grade, home_ownership, delinq_2yrs, revol_util, open_acc, pub_rec,
       revol_bal, installment, sub_grade, term, emp_length, purpose, addr_state, issue_d, verification_status,
       loan_status
FROM loans""")
def s05(spark, sf_dir):
    kept, _ = readers.column_contract(view(spark, sf_dir, "loans"), fx.LOAN_COLUMNS, fx.LOAN_STATUS)
    return kept


@query("s05_missing_columns", """
SELECT 'loan_amnt' AS "column", true AS present, count(loan_amnt) AS filled FROM loans
UNION ALL SELECT 'dti', true, count(dti) FROM loans UNION ALL SELECT 'fico_range', false, count(*) * 0 FROM loans""")
def s05_missing(spark, sf_dir):
    return readers.contract_report(view(spark, sf_dir, "loans"), ["loan_amnt", "dti", "fico_range"])


@query("s06_read_features", "SELECT loan_id, SeriousDlqin2yrs, age, DebtRatio FROM borrowers")
def s06(spark, sf_dir):
    path = scratch_path(spark, "features")
    view(spark, sf_dir, "borrowers").write.parquet(path)
    df, target = readers.read_features(spark, path, "snapshot")
    return df.select("loan_id", target, "age", "DebtRatio")


@query("s07_read_macro", """
SELECT CAST(year AS INT) AS year, CAST(quarter AS INT) AS quarter, unemployment_rate, gdp, fed_funds_rate,
       credit_card_delinq_rate
FROM macro_q""")
def s07(spark, sf_dir):
    return readers.read_macro(spark, _csv_copy(spark, view(spark, sf_dir, "macro_q"), "macro-csv"))


LOAN_FEATURES = """
WITH base AS (
  SELECT *, TRY_CAST(replace(int_rate, 'zz', '') AS DOUBLE) AS rate, TRY_CAST(revol_util AS DOUBLE) AS util,
         CASE WHEN issue_d = 'bad-date' THEN NULL
              ELSE CAST(strptime(issue_d, '%b-%Y') AS DATE) END AS issue_date
  FROM loans),
star AS (
  SELECT base.* REPLACE (rate AS int_rate, util AS revol_util, coalesce(delinq_2yrs, 0) AS delinq_2yrs),
         CAST(year(issue_date) AS INT) AS issue_year, CAST(quarter(issue_date) AS INT) AS issue_quarter,
         CAST((year((SELECT max(issue_date) FROM base)) - year(issue_date)) * 12
              + month((SELECT max(issue_date) FROM base)) - month(issue_date) AS INT) AS loan_vintage_months,
         CAST(CASE WHEN emp_length = '< 1 year' THEN 0 WHEN emp_length = '10+ years' THEN 10
              WHEN emp_length IS NULL OR emp_length = 'n/a' THEN -1
              ELSE CAST(split_part(emp_length, ' ', 1) AS INT) END AS INT) AS emp_length_years,
         CAST(CASE WHEN grade <= 'G' THEN ascii(grade) - 64 END AS INT) AS grade_numeric
  FROM base)
"""


@query("s08_write_features", f"""{LOAN_FEATURES}
SELECT loan_id, int_rate, issue_date, issue_year, issue_quarter, loan_vintage_months, emp_length_years, grade_numeric, unemployment_rate
FROM star LEFT JOIN macro_q ON issue_year = year AND issue_quarter = quarter""")
def s08(spark, sf_dir):
    path = scratch_path(spark, "features")
    sinks.write_parquet(star_source(spark, sf_dir), path, partition_by="issue_year")
    return spark.read.parquet(path).select("loan_id", "int_rate", "issue_date", "issue_year", "issue_quarter", "loan_vintage_months",
                                           "emp_length_years", "grade_numeric", "unemployment_rate")


def _star(name, columns, macro=False):
    source = "star LEFT JOIN macro_q ON issue_year = year AND issue_quarter = quarter" if macro else "star"

    @query(f"s09_{name}", f"{LOAN_FEATURES} SELECT {columns} FROM {source}")
    def build(spark, sf_dir):
        return sinks.star_tables(star_source(spark, sf_dir))[name]


_star("fact_loans", "loan_id, loan_amnt, funded_amnt, int_rate, installment")
_star("dim_borrower", "loan_id, annual_inc, dti, delinq_2yrs, revol_util, open_acc, pub_rec, emp_length_years")
_star("dim_loan_terms", "loan_id, grade, sub_grade, term, purpose, verification_status, grade_numeric")
_star("dim_geography", "loan_id, addr_state")
_star("dim_time", "loan_id, issue_date, issue_year, issue_quarter, loan_vintage_months")
_star("dim_macro", "loan_id, unemployment_rate, gdp, fed_funds_rate, credit_card_delinq_rate", macro=True)


_JDBC = {"loans_features": 39, "loans_fact_loans": 4, "loans_dim_borrower": 7, "loans_dim_loan_terms": 5, "loans_dim_geography": 2,
         "loans_dim_time": 4, "loans_dim_macro": 5}


@query("s10_jdbc_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST({n} AS INT) AS columns, count(*) AS rows FROM loans" for t, n in _JDBC.items()))
def s10(spark, sf_dir):
    """Tables, widths and row counts a JDBC load would write (nothing is connected here)."""
    counted = None
    for name, t in sinks.jdbc_tables(star_source(spark, sf_dir), "loans").items():
        row = t.agg(F.lit(name).alias("table_name"), F.lit(len(t.columns)).alias("columns"), F.count(F.lit(1)).alias("rows"))
        counted = row if counted is None else counted.unionByName(row)
    return counted


@query("s11_sink_choice", " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS path, count(*) AS rows FROM loans" for t in _JDBC))
def s11(spark, sf_dir):
    base = scratch_path(spark, "store")
    written = sinks.write_feature_store(star_source(spark, sf_dir), "loans", base, "parquet")
    return spark.createDataFrame([(p.removeprefix(base + "/"), spark.read.parquet(p).count()) for p in written], "path string, rows long")


@query("s12_rebuild_policy", """
SELECT 'first' AS step, count(*) AS rows FROM loans UNION ALL SELECT 'skipped', count(*) FROM loans
UNION ALL SELECT 'forced', count(*) FROM loans WHERE loan_status = 'Fully Paid'""")
def s12(spark, sf_dir):
    """Rows after a first write, a skipped rewrite and a forced one."""
    loans, path = view(spark, sf_dir, "loans"), scratch_path(spark, "store")
    paid = loans.filter("loan_status = 'Fully Paid'")
    steps = []
    for step, df, mode in (("first", loans, "ignore"), ("skipped", paid, "ignore"), ("forced", paid, "overwrite")):
        sinks.write_parquet(df, path, mode)
        steps.append((step, spark.read.parquet(path).count()))
    return spark.createDataFrame(steps, "step string, rows long")


