"""P1-P7 and the id-matched lookups J7, J8; scaling and detectors on other tables."""

from pyspark.sql import functions as F

from lendscope import fixed_values as fx
from lendscope.operators import cleaning, isolation, oversampling, reconstruction, sampling
from lendscope.operators.anomalies import attach_scores, labels_for
from workload.registry import query
from workload.views import table, view

TARGET = fx.SNAPSHOT_TARGET
SCALED = ("age", "DebtRatio", "RevolvingUtilizationOfUnsecuredLines", "NumberRealEstateLoansOrLines")


def labelled(spark, sf_dir):
    return cleaning.drop_null_target(view(spark, sf_dir, "borrowers"), TARGET)


SPLIT = """ranked AS (SELECT loan_id, SeriousDlqin2yrs,
    row_number() OVER (PARTITION BY SeriousDlqin2yrs ORDER BY md5(CAST(loan_id AS VARCHAR))) AS r,
    count(*) OVER (PARTITION BY SeriousDlqin2yrs) AS n FROM borrowers WHERE SeriousDlqin2yrs IS NOT NULL),
sized AS (SELECT *, round_even(0.15::DOUBLE * n, 0) AS t FROM ranked),
parts AS (SELECT loan_id, SeriousDlqin2yrs, CASE WHEN r <= t THEN 'test'
    WHEN r <= t + round_even(0.1765::DOUBLE * (n - t), 0) THEN 'validation' ELSE 'train' END AS split FROM sized)"""


@query("p01_stratified_split", f"WITH {SPLIT} SELECT * FROM parts")
def p01(spark, sf_dir):
    return sampling.stratified_split(labelled(spark, sf_dir), TARGET).select("loan_id", TARGET, "split")


HASHED = """CASE WHEN u < 0.15::DOUBLE THEN 'test' WHEN u < 0.15::DOUBLE + 0.1765::DOUBLE * (1 - 0.15::DOUBLE) THEN 'validation' ELSE 'train' END"""


@query("p01_hashed_split", f"""
SELECT loan_id, {HASHED} AS split FROM (
  SELECT loan_id, CAST(('0x' || substr(md5(CAST(loan_id AS VARCHAR)), 1, 13))::BIGINT AS DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM borrowers WHERE SeriousDlqin2yrs IS NOT NULL) h""")
def p01_hashed(spark, sf_dir):
    return sampling.hashed_split(labelled(spark, sf_dir)).select("loan_id", "split")


@query("p02_split_audit", f"""
WITH {SPLIT}
SELECT split, count(*) AS rows, round(avg(SeriousDlqin2yrs), 8) AS default_rate FROM parts GROUP BY split
UNION ALL SELECT 'overall', count(*), round(avg(SeriousDlqin2yrs), 8) FROM parts""")
def p02(spark, sf_dir):
    parts = sampling.stratified_split(labelled(spark, sf_dir), TARGET)
    return sampling.split_audit(parts, TARGET).withColumn("default_rate", F.round("default_rate", 8))


@query("p03_standardize", f"""
WITH {SPLIT}, train AS (SELECT borrowers.* FROM borrowers JOIN parts USING (loan_id) WHERE split = 'train'),
fit AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in SCALED)} FROM train)
SELECT loan_id, {', '.join(f'round(({c} - m_{c}) / s_{c}, 6) AS {c}' for c in SCALED)}
FROM borrowers, fit WHERE SeriousDlqin2yrs IS NOT NULL""")
def p03(spark, sf_dir):
    parts = sampling.stratified_split(labelled(spark, sf_dir), TARGET)
    scaler = sampling.fit_scaler(parts.filter("split = 'train'"), SCALED)
    return sampling.scale(parts, scaler).select("loan_id", *[F.round(c, 6).alias(c) for c in SCALED])


@query("p05_class_weights", """
WITH t AS (SELECT * FROM borrowers WHERE SeriousDlqin2yrs IS NOT NULL),
w AS (SELECT SeriousDlqin2yrs AS label, count(*) AS n FROM t GROUP BY 1)
SELECT loan_id, SeriousDlqin2yrs, round((SELECT sum(n) FROM w) / (2 * w.n)::DOUBLE, 8) AS class_weight
FROM t JOIN w ON SeriousDlqin2yrs = label""")
def p05(spark, sf_dir):
    weighted = sampling.add_class_weight(labelled(spark, sf_dir), TARGET)
    return weighted.select("loan_id", TARGET, F.round("class_weight", 8).alias("class_weight"))


@query("p06_hash_sample", """
SELECT loan_id, age FROM borrowers ORDER BY md5(CAST(loan_id AS VARCHAR)), loan_id LIMIT 500""")
def p06(spark, sf_dir):
    return sampling.hash_sample(view(spark, sf_dir, "borrowers"), fx.EXPLAIN_SAMPLE).select("loan_id", "age")


@query("p07_head_rows", "SELECT * FROM borrowers ORDER BY loan_id LIMIT 100")
def p07(spark, sf_dir):
    return sampling.head_rows(view(spark, sf_dir, "borrowers"), 100)


@query("j07_attach_scores", """
SELECT loan_id, age, DebtRatio, label, iso_forest_score, reconstruction_error FROM borrowers JOIN anom USING (loan_id)""")
def j07(spark, sf_dir):
    rows = view(spark, sf_dir, "borrowers").select("loan_id", "age", "DebtRatio")
    return attach_scores(rows, view(spark, sf_dir, "anom"))


@query("j08_labels_for_sample", """
SELECT loan_id, label FROM anom WHERE loan_id IN (
  SELECT loan_id FROM borrowers ORDER BY md5(CAST(loan_id AS VARCHAR)), loan_id LIMIT 500)""")
def j08(spark, sf_dir):
    picked = sampling.hash_sample(view(spark, sf_dir, "borrowers").select("loan_id"), fx.EXPLAIN_SAMPLE)
    return labels_for(view(spark, sf_dir, "anom").select("loan_id", "label"), picked)


QUALITY = """rated AS (SELECT doc_id, quality, toxic, n_chars, length(text) - length(replace(text, ' ', '')) AS n_spaces
  FROM documents JOIN labels USING (doc_id))"""


def rated_documents(spark, sf_dir):
    """A real, skewed 0/1 label with three numeric features of whole texts."""
    documents = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return documents.select("doc_id", "quality", "toxic", "n_chars",
                            (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).alias("n_spaces"))


@query("p05_document_weights", f"""
WITH {QUALITY}, w AS (SELECT quality AS label, count(*) AS n FROM rated WHERE quality IS NOT NULL GROUP BY 1)
SELECT doc_id, n_chars, CAST(n_spaces AS INT) AS n_spaces, quality, round((SELECT sum(n) FROM w) / (2 * w.n)::DOUBLE, 8) AS class_weight
FROM rated LEFT JOIN w ON quality = label""")
def p05_documents(spark, sf_dir):
    weighted = sampling.add_class_weight(rated_documents(spark, sf_dir), "quality")
    return weighted.select("doc_id", "n_chars", "n_spaces", "quality", F.round("class_weight", 8).alias("class_weight"))


@query("p04_document_balance")
def p04_documents(spark, sf_dir):
    """Given and synthetic rows of the skewed document label, both classes equally many."""
    rows = cleaning.feature_matrix(cleaning.drop_null_target(rated_documents(spark, sf_dir), "quality"), "quality", "doc_id")
    features = ["toxic", "n_chars", "n_spaces"]
    scaled = sampling.scale(rows, sampling.fit_scaler(rows, features))
    return oversampling.balance_classes(scaled, features, "quality", "doc_id")


def _dimensions(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    width = rows.select(F.max(F.size("embedding"))).first()[0]
    return rows.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(width)])


@query("p03_standardize_embeddings", """
WITH long AS (SELECT vec_id, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
fit AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM long GROUP BY i)
SELECT vec_id, concat('e', long.i) AS dimension, round((x - m) / s, 6) AS z FROM long JOIN fit USING (i)""")
def p03_embeddings(spark, sf_dir):
    rows = _dimensions(spark, sf_dir)
    names = [c for c in rows.columns if c != "vec_id"]
    scaled = sampling.scale(rows, sampling.fit_scaler(rows, names))
    return scaled.unpivot(["vec_id"], names, "dimension", "z").withColumn("z", F.round("z", 6))


@query("a03_embedding_error")
def a03_embeddings(spark, sf_dir):
    rows = _dimensions(spark, sf_dir)
    bottleneck = reconstruction.fit_bottleneck(rows, [c for c in rows.columns if c != "vec_id"], method="linear")
    return reconstruction.score_reconstruction(rows, bottleneck).select("vec_id", "reconstruction_error")


@query("a01_lineitem_isolation")
def a01_lineitem(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"), "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    forest = isolation.fit_isolation_forest(rows, rows.columns[1:], "line_id")
    return isolation.score_isolation(rows, forest).select("line_id", "iso_forest_score")
