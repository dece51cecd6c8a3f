"""A2, A4-A7 over given anomaly scores. (A1 and A3 are with the models.)"""

from lendscope.operators import anomalies
from workload.evaluation import bins_sql, rounded
from workload.registry import query
from workload.views import view

FLAGS = """flags AS (SELECT *, iso_forest_score > (SELECT quantile_cont(iso_forest_score, 0.99) FROM anom WHERE label = 0) AS is_iso_anomaly,
  reconstruction_error > (SELECT quantile_cont(reconstruction_error, 0.99) FROM anom) AS is_ae_anomaly FROM anom),
ensemble AS (SELECT *, is_iso_anomaly OR is_ae_anomaly AS is_ensemble_anomaly, is_iso_anomaly AND is_ae_anomaly AS strong_anomaly_flag FROM flags)"""


def flagged(spark, sf_dir):
    scores = view(spark, sf_dir, "anom")
    by_isolation = anomalies.flag_isolation(scores, scores.filter("label = 0"))
    return anomalies.flag_ensemble(anomalies.flag_reconstruction(by_isolation))


@query("a02_isolation_flag", f"WITH {FLAGS} SELECT loan_id, is_iso_anomaly FROM flags")
def a02(spark, sf_dir):
    scores = view(spark, sf_dir, "anom")
    return anomalies.flag_isolation(scores, scores.filter("label = 0")).select("loan_id", "is_iso_anomaly")


@query("a04_reconstruction_flag", f"WITH {FLAGS} SELECT loan_id, is_ae_anomaly FROM flags")
def a04(spark, sf_dir):
    return anomalies.flag_reconstruction(view(spark, sf_dir, "anom")).select("loan_id", "is_ae_anomaly")


@query("a05_ensemble_flags", f"WITH {FLAGS} SELECT loan_id, is_ensemble_anomaly, strong_anomaly_flag FROM ensemble")
def a05(spark, sf_dir):
    return flagged(spark, sf_dir).select("loan_id", "is_ensemble_anomaly", "strong_anomaly_flag")


@query("a06_anomaly_audit", f"""
WITH {FLAGS}, audit AS (SELECT count(*) AS evaluated, count(*) FILTER (is_iso_anomaly) AS iso_anomalies, count(*) FILTER (is_ae_anomaly) AS ae_anomalies,
  count(*) FILTER (strong_anomaly_flag) AS strong_anomalies, avg(CASE WHEN strong_anomaly_flag THEN label END) * 100 AS a,
  avg(CASE WHEN NOT strong_anomaly_flag THEN label END) * 100 AS b FROM ensemble)
SELECT evaluated, iso_anomalies, ae_anomalies, strong_anomalies, round(a, 6) AS anomaly_default_rate, round(b, 6) AS normal_default_rate,
  round(a / CASE WHEN b > 0.001 THEN b ELSE 0.001 END, 6) AS rate_ratio FROM audit""")
def a06(spark, sf_dir):
    audit = anomalies.anomaly_audit(flagged(spark, sf_dir))
    return rounded(audit, 6, "anomaly_default_rate", "normal_default_rate", "rate_ratio")


@query("a07_error_histogram", f"""
WITH logged AS (SELECT label, ln(1 + reconstruction_error) AS log_error FROM anom), {bins_sql('logged', 'log_error', 50, 'label')}
SELECT label, bin, round(low + bin * width, 6) AS bin_start, round(low + (bin + 1) * width, 6) AS bin_end, count(*) AS n,
  round(count(*) / ((SELECT count(*) FROM anom a WHERE a.label = binned.label) * ((low + (bin + 1) * width) - (low + bin * width))), 6) AS density
FROM binned GROUP BY label, bin, low, width""")
def a07(spark, sf_dir):
    return rounded(anomalies.error_histogram(view(spark, sf_dir, "anom")), 6, "bin_start", "bin_end", "density")


@query("a07_error_cutoff", """
SELECT round(quantile_cont(reconstruction_error, 0.99), 6) AS cutoff, round(ln(1 + quantile_cont(reconstruction_error, 0.99)), 6) AS log_cutoff FROM anom""")
def a07_cutoff(spark, sf_dir):
    return rounded(anomalies.error_cutoff(view(spark, sf_dir, "anom")), 6, "cutoff", "log_cutoff")
