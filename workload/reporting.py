"""R1-R7 over the synthetic scores and attributions."""

from pyspark.sql import functions as F

from lendscope.operators import attribution, evaluation, exploration, loss, reporting
from workload.cleaning import NUMBERS
from workload.evaluation import BEST, COUNTS, bins_sql, metrics, rounded
from workload.loss import SUMMARY, loans
from workload.registry import query
from workload.sampling import TARGET
from workload.views import view


@query("r01_overview", f"""
SELECT count(*) AS total_rows, CAST({len(NUMBERS)} AS INT) AS total_columns, round(avg(SeriousDlqin2yrs) * 100, 6) AS default_rate_pct,
  round(({' + '.join(f'avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)' for c in NUMBERS)}) / {len(NUMBERS)} * 100, 6) AS missing_pct
FROM borrowers""")
def r01(spark, sf_dir):
    return rounded(exploration.overview(view(spark, sf_dir, "borrowers"), TARGET), 6, "default_rate_pct", "missing_pct")


@query("r02_feature_histogram", f"""
WITH complete AS (SELECT SeriousDlqin2yrs, MonthlyIncome FROM borrowers
  WHERE MonthlyIncome IS NOT NULL AND SeriousDlqin2yrs IS NOT NULL),
{bins_sql('complete', 'MonthlyIncome', 60).replace('SELECT CAST(MonthlyIncome', 'SELECT SeriousDlqin2yrs, CAST(MonthlyIncome')}
SELECT SeriousDlqin2yrs, bin, round(low + bin * width, 6) AS bin_start, round(low + (bin + 1) * width, 6) AS bin_end, count(*) AS n
FROM binned GROUP BY SeriousDlqin2yrs, bin, low, width""")
def r02(spark, sf_dir):
    found = exploration.feature_histogram(view(spark, sf_dir, "borrowers"), "MonthlyIncome", TARGET)
    return rounded(found, 6, "bin_start", "bin_end")


BEST_SUMMARY = SUMMARY.replace("model = 'm1'", "model = (SELECT model FROM best)")


def best_loans(spark, sf_dir):
    """The portfolio of the best model."""
    return loans(spark, sf_dir, evaluation.best_model(metrics(spark, sf_dir)))


@query("r03_key_figures", f"""
WITH {BEST}, {BEST_SUMMARY}
SELECT total_loans, round(total_ead, 2) AS total_ead, round(total_expected_loss, 2) AS total_expected_loss,
  round(el_as_pct_of_ead, 6) AS el_as_pct_of_ead, model AS best_model, round(auc_roc, 6) AS best_auc, round(ks_statistic, 6) AS best_ks
FROM summary, best""")
def r03(spark, sf_dir):
    figures = reporting.key_figures(loss.portfolio_summary(best_loans(spark, sf_dir)), metrics(spark, sf_dir))
    return rounded(rounded(figures, 2, "total_ead", "total_expected_loss"), 6, "el_as_pct_of_ead", "best_auc", "best_ks")


@query("r04_radar", f"WITH {BEST} " + " UNION ALL ".join(
    f"SELECT model, '{label}' AS metric, round({c}, 6) AS value FROM best" for c, label in (
        ("auc_roc", "AUC-ROC"), ("gini", "Gini"), ("ks_statistic", "KS"), ('"precision"', "Precision"), ("recall", "Recall"), ("f1_score", "F1"))))
def r04(spark, sf_dir):
    return rounded(reporting.radar(metrics(spark, sf_dir)), 6, "value")


def _parts(spark, sf_dir):
    importance = attribution.global_importance(view(spark, sf_dir, "attr"))
    return metrics(spark, sf_dir), importance, loss.portfolio_summary(best_loans(spark, sf_dir))


@query("r05_model_card")
def r05(spark, sf_dir):
    return reporting.model_card(*_parts(spark, sf_dir), "snapshot", TARGET).select("model_name", "card_json")


@query("r06_validation_rows")
def r06(spark, sf_dir):
    return reporting.validation_rows(*_parts(spark, sf_dir))


PER_DATASET = (
    COUNTS.replace("SELECT model, score,", "SELECT dataset, model, score,")
    .replace("FROM scored GROUP BY model, score", "FROM labelled GROUP BY dataset, model, score")
    .replace("PARTITION BY model", "PARTITION BY dataset, model")
)


@query("r07_project_status", f"""
WITH labelled AS (SELECT CASE WHEN loan_id % 2 = 0 THEN 'even' ELSE 'odd' END AS dataset, model, label, score FROM scored),
{PER_DATASET},
aucs AS (SELECT dataset, model, sum(pos * (cum_neg - neg / 2.0::DOUBLE)) / (CAST(max(n_pos) AS DOUBLE) * max(n_neg)) AS auc_roc
  FROM above GROUP BY dataset, model),
best AS (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY auc_roc DESC, model) AS r FROM aucs)
SELECT dataset, model AS best_model, round(auc_roc, 8) AS auc_roc FROM best WHERE r = 1""")
def r07(spark, sf_dir):
    half = F.when(F.col("loan_id") % 2 == 0, "even").otherwise("odd")
    scores = view(spark, sf_dir, "scored").withColumn("dataset", half)
    return rounded(reporting.project_status(evaluation.auc_gini(scores, ["dataset", "model"])), 8, "auc_roc")
