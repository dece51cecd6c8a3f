"""L1-L6 over the scores of one synthetic model."""

from pyspark.sql import functions as F

from lendscope.operators import loss
from lendscope.operators.shared_storage import scratch_path
from lendscope.sources import readers, sinks
from workload.evaluation import rounded
from workload.registry import query
from workload.views import view

LOANS = """el AS (SELECT loan_id, score AS pd_predicted, 0.45::DOUBLE AS lgd, ead, score * 0.45::DOUBLE * ead AS expected_loss,
  CASE WHEN score < 0 OR score > 1 THEN NULL WHEN score <= 0.05 THEN 'A (Very Low)' WHEN score <= 0.10 THEN 'B (Low)'
       WHEN score <= 0.20 THEN 'C (Medium)' WHEN score <= 0.50 THEN 'D (High)' ELSE 'E (Very High)' END AS risk_grade
  FROM scored WHERE model = 'm1')"""
SEGMENTS = f"""{LOANS}, segments AS (SELECT risk_grade, count(*) AS loan_count, avg(pd_predicted) AS avg_pd, sum(ead) AS total_ead,
  sum(expected_loss) AS total_el, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM el) AS pct_of_portfolio,
  sum(expected_loss) / sum(ead) * 100 AS el_pct_of_ead FROM el WHERE risk_grade IS NOT NULL GROUP BY risk_grade)"""


def loans(spark, sf_dir, model="m1"):
    """Losses under one model, given by name or as a one-row frame with a column ``model``."""
    scored = view(spark, sf_dir, "scored")
    own = scored.filter(F.col("model") == model) if isinstance(model, str) else scored.join(F.broadcast(model.select("model")), "model")
    scores = own.select("loan_id", F.col("score").alias("pd_predicted"), "ead")
    return loss.grade_loans(loss.expected_loss(scores, ead="ead"))


def segments(spark, sf_dir):
    return loss.segment_summary(loans(spark, sf_dir))


@query("l01_expected_loss", f"WITH {LOANS} SELECT loan_id, pd_predicted, lgd, ead, expected_loss FROM el")
def l01(spark, sf_dir):
    return loans(spark, sf_dir).drop("risk_grade")


@query("l01_fixed_exposure", """
SELECT loan_id, score * 0.45::DOUBLE * 15000 AS expected_loss FROM scored WHERE model = 'm1'""")
def l01_fixed(spark, sf_dir):
    scores = view(spark, sf_dir, "scored").filter("model = 'm1'").withColumnRenamed("score", "pd_predicted")
    return loss.expected_loss(scores).select("loan_id", "expected_loss")


@query("l02_risk_grade", f"WITH {LOANS} SELECT loan_id, pd_predicted, risk_grade FROM el")
def l02(spark, sf_dir):
    return loans(spark, sf_dir).select("loan_id", "pd_predicted", "risk_grade")


SUMMARY = f"""{LOANS}, summary AS (SELECT count(*) AS total_loans, sum(ead) AS total_ead, sum(expected_loss) AS total_expected_loss,
  sum(expected_loss) / sum(ead) * 100 AS el_as_pct_of_ead, avg(pd_predicted) AS average_pd, quantile_cont(pd_predicted, 0.5) AS median_pd,
  0.45::DOUBLE AS lgd_assumption, 15000.0::DOUBLE AS fixed_ead_assumption FROM el)"""


@query("l03_portfolio_summary", f"""
WITH {SUMMARY} SELECT total_loans, round(total_ead, 2) AS total_ead, round(total_expected_loss, 2) AS total_expected_loss,
  round(el_as_pct_of_ead, 6) AS el_as_pct_of_ead, round(average_pd, 6) AS average_pd, round(median_pd, 6) AS median_pd,
  lgd_assumption, fixed_ead_assumption FROM summary""")
def l03(spark, sf_dir):
    summary = loss.portfolio_summary(loans(spark, sf_dir))
    return rounded(rounded(summary, 2, "total_ead", "total_expected_loss"), 6, "el_as_pct_of_ead", "average_pd", "median_pd")


@query("l04_el_by_grade", f"""
WITH {SEGMENTS} SELECT risk_grade, loan_count, round(avg_pd, 6) AS avg_pd, round(total_ead, 2) AS total_ead, round(total_el, 2) AS total_el,
  round(pct_of_portfolio, 6) AS pct_of_portfolio, round(el_pct_of_ead, 6) AS el_pct_of_ead FROM segments""")
def l04(spark, sf_dir):
    return rounded(rounded(segments(spark, sf_dir), 2, "total_ead", "total_el"), 6, "avg_pd", "pct_of_portfolio", "el_pct_of_ead")


@query("l05_segment_share", f"""
WITH {SEGMENTS} SELECT risk_grade, loan_count, round(loan_count * 100.0::DOUBLE / sum(loan_count) OVER (), 6) AS share_pct FROM segments""")
def l05(spark, sf_dir):
    return rounded(loss.segment_share(segments(spark, sf_dir)), 6, "share_pct")


@query("l06_cumulative_loss", f"""
WITH {SEGMENTS} SELECT risk_grade, round(total_el, 2) AS total_el,
  round(sum(total_el) OVER (ORDER BY risk_grade ROWS UNBOUNDED PRECEDING), 2) AS cumulative_el FROM segments""")
def l06(spark, sf_dir):
    return rounded(loss.cumulative_loss(segments(spark, sf_dir)), 2, "total_el", "cumulative_el")


ROUNDED_SEGMENTS = f"""WITH {SEGMENTS} SELECT risk_grade, loan_count, round(avg_pd, 6) AS avg_pd, round(total_ead, 2) AS total_ead,
  round(total_el, 2) AS total_el, round(pct_of_portfolio, 6) AS pct_of_portfolio, round(el_pct_of_ead, 6) AS el_pct_of_ead FROM segments"""


def _stored(spark, sf_dir, fmt):
    """Segments written as a result file and read back, with an artifact that was never written."""
    path, result = scratch_path(spark, "segments"), segments(spark, sf_dir)
    sinks.write_result(result, path, fmt)
    absent = readers.read_artifact(spark, path + "-absent", result.schema, fmt)
    stored = readers.read_artifact(spark, path, result.schema, fmt).unionByName(absent)
    return rounded(rounded(stored, 2, "total_ead", "total_el"), 6, "avg_pd", "pct_of_portfolio", "el_pct_of_ead")


@query("s13_result_sinks", ROUNDED_SEGMENTS)
def s13(spark, sf_dir):
    return _stored(spark, sf_dir, "csv")


@query("s15_artifact_readers", ROUNDED_SEGMENTS)
def s15(spark, sf_dir):
    return _stored(spark, sf_dir, "json")
