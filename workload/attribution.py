"""X1, X3-X5. (Attributions of fitted models are with the models.)"""

from lendscope.operators import attribution, cleaning
from workload.evaluation import rounded
from workload.registry import query
from workload.sampling import TARGET
from workload.views import view

COEFFICIENTS = {"age": -0.03, "DebtRatio": 0.4, "RevolvingUtilizationOfUnsecuredLines": 1.7, "NumberRealEstateLoansOrLines": 0.25}


@query("x01_linear_attributions", "WITH t AS (SELECT * FROM borrowers WHERE SeriousDlqin2yrs IS NOT NULL) " + " UNION ALL ".join(
    f"""SELECT loan_id AS row_id, '{f}' AS feature, CAST({f} AS DOUBLE) AS value,
  round({b}::DOUBLE * ({f} - (SELECT avg({f}) FROM t)), 6) AS shap FROM t""" for f, b in COEFFICIENTS.items()))
def x01(spark, sf_dir):
    rows = cleaning.drop_null_target(view(spark, sf_dir, "borrowers"), TARGET)
    return rounded(attribution.linear_attributions(rows, COEFFICIENTS), 6, "shap")


IMPORTANCE = "importance AS (SELECT feature, avg(abs(shap)) AS mean_abs_shap FROM attr GROUP BY feature)"


@query("x03_global_importance", f"WITH {IMPORTANCE} SELECT feature, round(mean_abs_shap, 8) AS mean_abs_shap FROM importance")
def x03(spark, sf_dir):
    return rounded(attribution.global_importance(view(spark, sf_dir, "attr")), 8, "mean_abs_shap")


@query("x04_top_features", f"""
WITH {IMPORTANCE} SELECT CAST(row_number() OVER (ORDER BY mean_abs_shap DESC, feature) AS INT) AS rank, feature,
  round(mean_abs_shap, 8) AS mean_abs_shap FROM importance ORDER BY rank LIMIT 15""")
def x04(spark, sf_dir):
    importance = attribution.global_importance(view(spark, sf_dir, "attr"))
    return rounded(attribution.top_features(importance, 15), 8, "mean_abs_shap")


@query("x05_explain_row", """
WITH one AS (SELECT * FROM attr WHERE row_id = (SELECT min(row_id) FROM attr))
SELECT row_id, CAST(row_number() OVER w AS INT) AS rank, feature, value, shap, 0.5::DOUBLE AS base_value,
  sum(shap) OVER (w ROWS UNBOUNDED PRECEDING) + 0.5::DOUBLE AS running FROM one WINDOW w AS (ORDER BY abs(shap) DESC, feature)""")
def x05(spark, sf_dir):
    attributions = view(spark, sf_dir, "attr")
    first = attributions.agg({"row_id": "min"}).first()[0]
    return attribution.explain_row(attributions, first, base_value=0.5)
