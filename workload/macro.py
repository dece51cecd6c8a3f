"""J1-J6."""

from pyspark.sql import functions as F

from lendscope.operators import features, macro
from workload.features import DATED
from workload.registry import query
from workload.views import view

MEASURES = "unemployment_rate, gdp, fed_funds_rate, credit_card_delinq_rate"
JOINED = f"""{DATED}, joined AS (SELECT loan_id, CAST(year(issue_date) AS INT) AS issue_year, CAST(quarter(issue_date) AS INT) AS issue_quarter,
  {MEASURES} FROM dated LEFT JOIN macro_q ON year(issue_date) = year AND quarter(issue_date) = quarter)"""


def _joined(spark, sf_dir):
    loans = features.issue_parts(view(spark, sf_dir, "loans")).select("loan_id", "issue_year", "issue_quarter")
    return macro.join_macro(loans, view(spark, sf_dir, "macro_q"))


@query("j01_join_macro", f"WITH {JOINED} SELECT * FROM joined")
def j01(spark, sf_dir):
    return _joined(spark, sf_dir)


@query("j02_match_rate", f"""WITH {JOINED} SELECT count(unemployment_rate) AS matched, count(*) AS total,
  round(count(unemployment_rate) * 100.0::DOUBLE / count(*), 6) AS pct_matched FROM joined""")
def j02(spark, sf_dir):
    return macro.macro_match_rate(_joined(spark, sf_dir)).withColumn("pct_matched", F.round("pct_matched", 6))


@query("j03_constant_macro", f"""
SELECT loan_id, {MEASURES} FROM borrowers CROSS JOIN (SELECT {MEASURES} FROM macro_q WHERE year = 1999 AND quarter = 4) q""")
def j03(spark, sf_dir):
    loans = view(spark, sf_dir, "borrowers").select("loan_id")
    return macro.constant_macro(loans, view(spark, sf_dir, "macro_q"), (1999, 4))


def _pick(s):
    return f"avg(CASE WHEN series_id = '{s}' THEN value END) AS {s}"


ALIGNED = f"aligned AS (SELECT obs_date, {', '.join(map(_pick, macro.fx.MACRO_SERIES))} FROM macro_obs GROUP BY obs_date)"
QUARTERS = f"""{ALIGNED}, means AS (SELECT CAST(date_trunc('quarter', obs_date) AS DATE) AS quarter_start,
  {', '.join(f'avg({s}) AS {s}' for s in macro.fx.MACRO_SERIES)} FROM aligned GROUP BY 1),
calendar AS (SELECT CAST(unnest(generate_series(min(quarter_start)::TIMESTAMP, max(quarter_start)::TIMESTAMP, INTERVAL 3 MONTH)) AS DATE) AS quarter_start FROM means),
quarters AS (SELECT calendar.quarter_start, {', '.join(macro.fx.MACRO_SERIES)} FROM calendar LEFT JOIN means USING (quarter_start))"""


@query("j04_align_series", f"WITH {ALIGNED} SELECT * FROM aligned")
def j04(spark, sf_dir):
    return macro.align_series(view(spark, sf_dir, "macro_obs"))


@query("j05_resample_quarter", f"WITH {QUARTERS} SELECT * FROM quarters")
def j05(spark, sf_dir):
    return macro.quarter_means(macro.align_series(view(spark, sf_dir, "macro_obs")))


@query("j06_name_measures", f"""WITH {QUARTERS} SELECT CAST(year(quarter_start) AS INT) AS year, CAST(quarter(quarter_start) AS INT) AS quarter,
  {', '.join(f'{s} AS {m}' for s, m in macro.fx.MACRO_SERIES.items())} FROM quarters""")
def j06(spark, sf_dir):
    return macro.quarterly_macro(view(spark, sf_dir, "macro_obs"))
