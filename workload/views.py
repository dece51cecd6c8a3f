"""Loan-shaped views over the test tables, as SQL text for both engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "line_agg": """
SELECT l_orderkey, CAST(count(*) AS INT) AS n_lines,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INT) AS n_r,
       CAST(sum(CASE WHEN l_linestatus = 'F' AND l_quantity > 40 THEN 1 ELSE 0 END) AS INT) AS n_f,
       max(l_extendedprice) AS max_price
FROM lineitem GROUP BY l_orderkey
""",
    "loans": """
SELECT o_orderkey AS loan_id, o_totalprice AS loan_amnt, o_totalprice AS funded_amnt,
       CASE WHEN o_orderkey % 3 = 0 THEN '60 months' ELSE '36 months' END AS term,
       CASE WHEN o_orderkey % 41 = 0 THEN 'n/a'
            ELSE concat(CAST(5 + o_orderkey % 20 AS STRING), '.5%') END AS int_rate,
       o_totalprice / CAST(36 AS DOUBLE) AS installment,
       substr('ABCDEFGH', CAST(1 + o_orderkey % 8 AS INT), 1) AS grade,
       concat(substr('ABCDEFGH', CAST(1 + o_orderkey % 8 AS INT), 1), CAST(1 + o_orderkey % 5 AS STRING)) AS sub_grade,
       CASE o_custkey % 13 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
            WHEN 11 THEN 'n/a' WHEN 12 THEN NULL
            ELSE concat(CAST(o_custkey % 13 AS STRING), ' years') END AS emp_length,
       c_mktsegment AS home_ownership, c_acctbal * CAST(10 AS DOUBLE) AS annual_inc,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Verified' ELSE 'Not Verified' END AS verification_status,
       CASE WHEN o_orderkey % 53 = 0 THEN 'bad-date'
            ELSE concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * month(o_orderdate) - 2 AS INT), 3),
                        '-', CAST(year(o_orderdate) AS STRING)) END AS issue_d,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 5 = 0 THEN 'Default'
            WHEN o_orderstatus = 'F' THEN 'Charged Off'
            WHEN o_orderstatus = 'O' THEN 'Fully Paid' ELSE 'Current' END AS loan_status,
       o_orderpriority AS purpose, n_name AS addr_state,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_orderkey % 70 AS DOUBLE) END AS dti,
       CAST(n_r AS DOUBLE) AS delinq_2yrs, CAST(n_lines AS DOUBLE) AS open_acc,
       CAST(o_orderkey % 2 AS DOUBLE) AS pub_rec, max_price AS revol_bal,
       concat(CAST(o_orderkey % 111 AS STRING), '.0%') AS revol_util,
       CAST(n_lines + 3 AS DOUBLE) AS total_acc
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN nation ON c_nationkey = n_nationkey
            LEFT JOIN line_agg ON o_orderkey = l_orderkey
""",
    "borrowers_base": """
SELECT o_orderkey AS loan_id,
       CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE NULL END AS SeriousDlqin2yrs,
       CAST(o_orderkey % 120 AS DOUBLE) / CAST(100 AS DOUBLE) AS RevolvingUtilizationOfUnsecuredLines,
       CAST(10 + o_custkey % 75 AS INT) AS age,
       CASE WHEN o_orderkey % 50 = 0 THEN 96 WHEN o_orderkey % 50 = 1 THEN 98 ELSE n_r END AS NumberOfTime30_59DaysPastDueNotWorse,
       CAST(o_orderkey % 37 AS DOUBLE) / CAST(10 AS DOUBLE) AS DebtRatio,
       CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS MonthlyIncome,
       n_lines AS NumberOfOpenCreditLinesAndLoans,
       CASE WHEN o_orderkey % 50 = 2 THEN 98 ELSE n_f END AS NumberOfTimes90DaysLate,
       CAST(o_orderkey % 4 AS INT) AS NumberRealEstateLoansOrLines,
       CASE WHEN o_orderkey % 50 = 3 THEN 96 ELSE CAST(o_orderkey % 2 AS INT) END AS NumberOfTime60_89DaysPastDueNotWorse,
       CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE CAST(o_custkey % 6 AS DOUBLE) END AS NumberOfDependents
FROM orders LEFT JOIN customer ON o_custkey = c_custkey
            LEFT JOIN line_agg ON o_orderkey = l_orderkey
""",
    "borrowers": """
SELECT * FROM borrowers_base
UNION ALL
SELECT loan_id + 1000000000 AS loan_id, SeriousDlqin2yrs, RevolvingUtilizationOfUnsecuredLines, age,
       NumberOfTime30_59DaysPastDueNotWorse, DebtRatio, MonthlyIncome, NumberOfOpenCreditLinesAndLoans,
       NumberOfTimes90DaysLate, NumberRealEstateLoansOrLines, NumberOfTime60_89DaysPastDueNotWorse, NumberOfDependents
FROM borrowers_base WHERE loan_id % 100 = 0
""",
    "macro_obs": """
SELECT m AS obs_date, s AS series_id,
       CASE s WHEN 'UNRATE' THEN CAST(4 + (month(m) * 7 + year(m)) % 6 AS DOUBLE)
              WHEN 'GDP' THEN CAST((year(m) * 3 + month(m)) % 9 - 3 AS DOUBLE)
              WHEN 'FEDFUNDS' THEN CAST((year(m) * 5 + month(m) * 2) % 11 AS DOUBLE) / CAST(2 AS DOUBLE)
              ELSE CAST((year(m) + month(m)) % 5 AS DOUBLE) END AS value
FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders) months
CROSS JOIN (SELECT 'UNRATE' AS s UNION ALL SELECT 'GDP' UNION ALL SELECT 'FEDFUNDS' UNION ALL SELECT 'DRCCLACBS') series
WHERE NOT (year(m) = 1997 AND month(m) BETWEEN 4 AND 9)
  AND (s IN ('UNRATE', 'FEDFUNDS') OR month(m) IN (1, 4, 7, 10))
""",
    "macro_q": """
SELECT year(obs_date) AS year, quarter(obs_date) AS quarter,
       avg(CASE WHEN series_id = 'UNRATE' THEN value END) AS unemployment_rate,
       avg(CASE WHEN series_id = 'GDP' THEN value END) AS gdp,
       avg(CASE WHEN series_id = 'FEDFUNDS' THEN value END) AS fed_funds_rate,
       avg(CASE WHEN series_id = 'DRCCLACBS' THEN value END) AS credit_card_delinq_rate
FROM macro_obs GROUP BY year(obs_date), quarter(obs_date)
""",
    "scored": """
SELECT model, o_orderkey AS loan_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
       CAST((o_orderkey * mult) % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) * (CAST(1 AS DOUBLE) - lift)
       + CASE WHEN o_orderstatus = 'F' THEN lift ELSE CAST(0 AS DOUBLE) END AS score,
       o_totalprice AS ead
FROM orders CROSS JOIN (SELECT 'm1' AS model, CAST(7919 AS BIGINT) AS mult, CAST(0.25 AS DOUBLE) AS lift
             UNION ALL SELECT 'm2', CAST(104729 AS BIGINT), CAST(0.5 AS DOUBLE)
             UNION ALL SELECT 'm3', CAST(1299709 AS BIGINT), CAST(0 AS DOUBLE)) models
WHERE o_orderstatus IN ('F', 'O')
""",
    "perf": """
SELECT user_id AS loan_seq_num, ts AS rpt_ts, event_id AS tie,
       value AS current_upb, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS delinq
FROM events
""",
    "anom": """
SELECT o_orderkey AS loan_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
       CAST((o_orderkey * 31) % 997 AS DOUBLE) / CAST(997 AS DOUBLE) AS iso_forest_score,
       CAST((o_orderkey * 17) % 1009 AS DOUBLE) / CAST(100 AS DOUBLE) AS reconstruction_error
FROM orders
""",
    "attr": """
SELECT loan_id AS row_id, feature,
       CASE feature WHEN 'age' THEN CAST(age AS DOUBLE) WHEN 'DebtRatio' THEN DebtRatio
            ELSE RevolvingUtilizationOfUnsecuredLines END AS value,
       CAST((loan_id * k) % 41 - 20 AS DOUBLE) / CAST(64 AS DOUBLE) AS shap
FROM borrowers_base CROSS JOIN (SELECT 'age' AS feature, 3 AS k UNION ALL SELECT 'DebtRatio', 5
                                UNION ALL SELECT 'RevolvingUtilizationOfUnsecuredLines', 11) f
""",
}
# The same rows without a join against constants: Spark expands them from an array per row.
SPARK_SOURCES = {
    "macro_obs": (
        """CROSS JOIN (SELECT 'UNRATE' AS s UNION ALL SELECT 'GDP' UNION ALL SELECT 'FEDFUNDS' UNION ALL SELECT 'DRCCLACBS') series""",
        """LATERAL VIEW explode(array('UNRATE', 'GDP', 'FEDFUNDS', 'DRCCLACBS')) series AS s""",
    ),
    "scored": (
        """CROSS JOIN (SELECT 'm1' AS model, CAST(7919 AS BIGINT) AS mult, CAST(0.25 AS DOUBLE) AS lift
             UNION ALL SELECT 'm2', CAST(104729 AS BIGINT), CAST(0.5 AS DOUBLE)
             UNION ALL SELECT 'm3', CAST(1299709 AS BIGINT), CAST(0 AS DOUBLE)) models""",
        """LATERAL VIEW inline(array(struct('m1', 7919L, 0.25D), struct('m2', 104729L, 0.5D),
                                    struct('m3', 1299709L, 0D))) models AS model, mult, lift""",
    ),
    "attr": (
        """CROSS JOIN (SELECT 'age' AS feature, 3 AS k UNION ALL SELECT 'DebtRatio', 5
                                UNION ALL SELECT 'RevolvingUtilizationOfUnsecuredLines', 11) f""",
        """LATERAL VIEW inline(array(struct('age', 3), struct('DebtRatio', 5),
                                     struct('RevolvingUtilizationOfUnsecuredLines', 11))) f AS feature, k""",
    ),
}


def _used(text: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", text)]


def needed_views(text: str) -> list[str]:
    """Views a text uses, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in _used(VIEWS[name], VIEWS):
            if other != name and other not in order:
                visit(other)
        if name not in order:
            order.append(name)

    for name in _used(text, VIEWS):
        visit(name)
    return order


def with_views(sql: str) -> str:
    """SQL for DuckDB with its views as WITH clauses."""
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in needed_views(sql)]
    body = sql.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _spark_text(name: str) -> str:
    text = VIEWS[name]
    if name in SPARK_SOURCES:
        old, new = SPARK_SOURCES[name]
        if old not in text:
            raise ValueError(f"view {name} changed")
        text = text.replace(old, new)
    return text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view as a DataFrame over the tables of one scale folder."""
    order = needed_views(name)
    for t in TABLES:
        if any(_used(VIEWS[n], [t]) for n in order):
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    for n in order:
        spark.sql(_spark_text(n)).createOrReplaceTempView(n)
    return spark.table(name)
