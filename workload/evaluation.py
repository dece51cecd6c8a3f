"""E1-E11, M7 and J9 over the synthetic scores."""

from pyspark.sql import functions as F

from lendscope.operators import evaluation, histograms
from lendscope.operators.reporting import competing_models
from workload.registry import query
from workload.views import view


def rounded(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


COUNTS = """counts AS (SELECT model, score, CAST(sum(label) AS BIGINT) AS pos, count(*) - CAST(sum(label) AS BIGINT) AS neg
  FROM scored GROUP BY model, score),
running AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
  sum(pos) OVER (PARTITION BY model) AS n_pos, sum(neg) OVER (PARTITION BY model) AS n_neg FROM counts
  WINDOW w AS (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING)),
above AS (SELECT *, CAST(n_pos - cum_pos + pos AS DOUBLE) AS tp, CAST(n_neg - cum_neg + neg AS DOUBLE) AS fp FROM running)"""
AUC = "sum(pos * (cum_neg - neg / 2.0::DOUBLE)) / (CAST(max(n_pos) AS DOUBLE) * max(n_neg))"
KS = "max(abs(CAST(cum_pos AS DOUBLE) / n_pos - CAST(cum_neg AS DOUBLE) / n_neg))"
AP = "sum(CAST(pos AS DOUBLE) / n_pos * tp / (tp + fp))"


@query("e01_auc_gini", f"""
WITH {COUNTS} SELECT model, round({AUC}, 8) AS auc_roc, round(2 * {AUC} - 1, 8) AS gini FROM above GROUP BY model""")
def e01(spark, sf_dir):
    return rounded(evaluation.auc_gini(view(spark, sf_dir, "scored")), 8, "auc_roc", "gini")


@query("e02_ks", f"WITH {COUNTS} SELECT model, round({KS}, 8) AS ks_statistic FROM above GROUP BY model")
def e02(spark, sf_dir):
    return rounded(evaluation.ks_statistic(view(spark, sf_dir, "scored")), 8, "ks_statistic")


@query("e03_average_precision", f"WITH {COUNTS} SELECT model, round({AP}, 8) AS pr_auc FROM above GROUP BY model")
def e03(spark, sf_dir):
    return rounded(evaluation.average_precision(view(spark, sf_dir, "scored")), 8, "pr_auc")


CONFUSION = """confusion AS (SELECT model, count(*) FILTER (label = 0 AND score <= 0.5) AS true_negatives,
  count(*) FILTER (label = 0 AND score > 0.5) AS false_positives, count(*) FILTER (label = 1 AND score <= 0.5) AS false_negatives,
  count(*) FILTER (label = 1 AND score > 0.5) AS true_positives FROM scored GROUP BY model),
rates AS (SELECT *, (true_positives + true_negatives)::DOUBLE / (true_positives + true_negatives + false_positives + false_negatives) AS accuracy,
  coalesce(true_positives::DOUBLE / nullif(true_positives + false_positives, 0), 0) AS "precision",
  coalesce(true_positives::DOUBLE / nullif(true_positives + false_negatives, 0), 0) AS recall,
  coalesce((2 * true_positives)::DOUBLE / nullif(2 * true_positives + false_positives + false_negatives, 0), 0) AS f1_score FROM confusion)"""


@query("e04_confusion", f"WITH {CONFUSION} SELECT * FROM confusion")
def e04(spark, sf_dir):
    return evaluation.confusion_counts(view(spark, sf_dir, "scored"))


@query("e05_label_rates", f"""
WITH {CONFUSION} SELECT model, round(accuracy, 8) AS accuracy, round("precision", 8) AS "precision", round(recall, 8) AS recall,
  round(f1_score, 8) AS f1_score FROM rates""")
def e05(spark, sf_dir):
    rates = evaluation.label_rates(evaluation.confusion_counts(view(spark, sf_dir, "scored")))
    columns = ("accuracy", "precision", "recall", "f1_score")
    return rounded(rates, 8, *columns).select("model", *columns)


METRICS = f"""{COUNTS}, {CONFUSION},
curves AS (SELECT model, {AUC} AS auc_roc, 2 * {AUC} - 1 AS gini, {KS} AS ks_statistic, {AP} AS pr_auc FROM above GROUP BY model),
metrics AS (SELECT model, auc_roc, gini, ks_statistic, pr_auc, f1_score, accuracy, true_positives, true_negatives, false_positives,
  false_negatives, "precision", recall FROM curves JOIN rates USING (model))"""


def metrics(spark, sf_dir):
    return evaluation.model_comparison(view(spark, sf_dir, "scored"))


@query("e06_model_comparison", f"""
WITH {METRICS} SELECT model, round(auc_roc, 4) AS auc_roc, round(gini, 4) AS gini, round(ks_statistic, 4) AS ks_statistic,
  round(pr_auc, 4) AS pr_auc, round(f1_score, 4) AS f1_score, round(accuracy, 4) AS accuracy, true_positives, true_negatives,
  false_positives, false_negatives, round("precision", 4) AS "precision", round(recall, 4) AS recall FROM metrics""")
def e06(spark, sf_dir):
    return rounded(metrics(spark, sf_dir), 4, "auc_roc", "gini", "ks_statistic", "pr_auc", "f1_score", "accuracy", "precision", "recall")


@query("e07_roc_points", f"""
WITH {COUNTS}, bends AS (SELECT *, lag(pos) OVER w AS prev_pos, lag(neg) OVER w AS prev_neg FROM above
  WINDOW w AS (PARTITION BY model ORDER BY score))
SELECT model, fp / n_neg AS fpr, tp / n_pos AS tpr, score AS threshold FROM bends
WHERE cum_pos + cum_neg = n_pos + n_neg OR prev_pos IS NULL OR prev_pos <> pos OR prev_neg <> neg
UNION ALL SELECT DISTINCT model, 0.0::DOUBLE, 0.0::DOUBLE, 'Infinity'::DOUBLE FROM scored""")
def e07(spark, sf_dir):
    return evaluation.roc_points(view(spark, sf_dir, "scored"))


@query("e08_precision_recall_points", f"""
WITH {COUNTS} SELECT model, tp / (tp + fp) AS "precision", tp / n_pos AS recall, score AS threshold FROM above
UNION ALL SELECT DISTINCT model, 1.0::DOUBLE, 0.0::DOUBLE, CAST(NULL AS DOUBLE) FROM scored""")
def e08(spark, sf_dir):
    return evaluation.precision_recall_points(view(spark, sf_dir, "scored"))


GRID = f"""{COUNTS}, grid AS (SELECT CAST(range AS INT) AS point, CASE WHEN range = 499 THEN 1.0::DOUBLE ELSE range * (1.0::DOUBLE / 499.0::DOUBLE) END AS threshold
  FROM range(500)),
curve AS (SELECT model, point, threshold, CAST(sum(CASE WHEN score <= threshold THEN pos ELSE 0 END) AS DOUBLE) / max(n_pos) AS cdf_default,
  CAST(sum(CASE WHEN score <= threshold THEN neg ELSE 0 END) AS DOUBLE) / max(n_neg) AS cdf_non_default
  FROM above, grid GROUP BY model, point, threshold)"""


@query("e09_ks_curve", f"""
WITH {GRID} SELECT model, point, round(threshold, 8) AS threshold, round(cdf_default, 8) AS cdf_default,
  round(cdf_non_default, 8) AS cdf_non_default, round(abs(cdf_default - cdf_non_default), 8) AS gap FROM curve""")
def e09(spark, sf_dir):
    return rounded(evaluation.ks_curve(view(spark, sf_dir, "scored")), 8, "threshold", "cdf_default", "cdf_non_default", "gap")


@query("e09_ks_point", f"""
WITH {GRID}, gaps AS (SELECT model, point, threshold, abs(cdf_default - cdf_non_default) AS gap FROM curve),
best AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY gap DESC, point) AS r FROM gaps)
SELECT model, point, round(threshold, 8) AS threshold, round(gap, 8) AS gap FROM best WHERE r = 1""")
def e09_point(spark, sf_dir):
    return rounded(evaluation.ks_point(evaluation.ks_curve(view(spark, sf_dir, "scored"))), 8, "threshold", "gap")


def bins_sql(source, column, bins, by=None):
    """Equal-width histogram text with the same edge corrections."""
    part = f"PARTITION BY {by}" if by else ""
    keep = f"{by}, " if by else ""
    return f"""spread AS (SELECT {keep}CAST({column} AS DOUBLE) AS x, CAST(min({column}) OVER ({part}) AS DOUBLE) AS low,
  CAST(max({column}) OVER ({part}) AS DOUBLE) AS high FROM {source} WHERE {column} IS NOT NULL),
guess AS (SELECT *, (high - low) / {bins} AS width, least(floor((x - low) / (high - low) * {bins}), {bins} - 1) AS g FROM spread),
down AS (SELECT *, CASE WHEN x < low + g * width THEN g - 1 ELSE g END AS d FROM guess),
binned AS (SELECT *, CAST(CASE WHEN d < {bins} - 1 AND x >= low + (d + 1) * width THEN d + 1 ELSE d END AS INT) AS bin FROM down)"""


@query("e10_pd_histogram", f"""
WITH m1 AS (SELECT score FROM scored WHERE model = 'm1'), {bins_sql('m1', 'score', 50)}
SELECT bin, round(low + bin * width, 8) AS bin_start, round(low + (bin + 1) * width, 8) AS bin_end, count(*) AS n
FROM binned GROUP BY bin, low, width""")
def e10(spark, sf_dir):
    return rounded(histograms.histogram(view(spark, sf_dir, "scored").filter("model = 'm1'"), "score", 50), 8, "bin_start", "bin_end")


@query("e10_loss_histogram", f"""
WITH el AS (SELECT score * 0.45::DOUBLE * ead AS expected_loss FROM scored WHERE model = 'm1'), {bins_sql('el', 'expected_loss', 50)}
SELECT bin, round(low + bin * width, 6) AS bin_start, round(low + (bin + 1) * width, 6) AS bin_end, count(*) AS n
FROM binned GROUP BY bin, low, width""")
def e10_loss(spark, sf_dir):
    from workload.loss import loans

    return rounded(histograms.histogram(loans(spark, sf_dir), "expected_loss", 50), 6, "bin_start", "bin_end")


@query("e10_pd_centre", """
SELECT round(avg(score), 8) AS mean, round(quantile_cont(score, 0.5), 8) AS median FROM scored WHERE model = 'm1'""")
def e10_centre(spark, sf_dir):
    return rounded(histograms.centre(view(spark, sf_dir, "scored").filter("model = 'm1'"), "score"), 8, "mean", "median")


@query("e11_ratings", f"""
WITH {METRICS} SELECT model, round(auc_roc, 8) AS auc_roc,
  CASE WHEN auc_roc > 0.85 THEN 'Excellent' WHEN auc_roc > 0.75 THEN 'Good' ELSE 'Below Threshold' END AS auc_rating,
  round(gini, 8) AS gini, CASE WHEN gini > 0.65 THEN 'Excellent' ELSE 'Acceptable' END AS gini_rating, round(ks_statistic, 8) AS ks_statistic,
  CASE WHEN ks_statistic > 0.4 THEN 'Excellent' WHEN ks_statistic > 0.2 THEN 'Acceptable' ELSE 'Weak' END AS ks_rating FROM metrics""")
def e11(spark, sf_dir):
    return rounded(evaluation.rated_metrics(metrics(spark, sf_dir)), 8, "auc_roc", "gini", "ks_statistic")


BEST = f"{METRICS}, best AS (SELECT * FROM metrics ORDER BY auc_roc DESC, model LIMIT 1)"


@query("m07_best_model", f"WITH {BEST} SELECT model, round(auc_roc, 8) AS auc_roc, round(ks_statistic, 8) AS ks_statistic FROM best")
def m07(spark, sf_dir):
    best = evaluation.best_model(metrics(spark, sf_dir)).select("model", "auc_roc", "ks_statistic")
    return rounded(best, 8, "auc_roc", "ks_statistic")


@query("j09_competing_models", f"""
WITH {BEST} SELECT model, round(auc_roc, 8) AS auc_roc, round(ks_statistic, 8) AS ks_statistic FROM metrics
WHERE model NOT IN (SELECT model FROM best)""")
def j09(spark, sf_dir):
    return rounded(competing_models(metrics(spark, sf_dir)), 8, "auc_roc", "ks_statistic")
