"""Checkable facts about results that have no SQL of their own: fitted models, scores, attributions, runs.

Each query computes its facts over all rows of the result in question; the SQL states what they have to be.
"""

from functools import lru_cache

from pyspark.sql import functions as F

from lendscope import fixed_values as fx
from lendscope.operators import cleaning, evaluation, isolation, rank_sketches, reconstruction
from lendscope.operators.shared_storage import cut_lineage, join_large, scratch_path
from lendscope.plans import ingestion, training
from lendscope.sources import readers, schemas, sinks
from workload import composites, models
from workload.cleaning import CONTENT, FEATURES as COLUMNS
from workload.registry import query
from workload.sampling import SPLIT
from workload.sequences import BLOCKS
from workload.sources import plain, snapshot
from workload.views import view

TARGET = fx.SNAPSHOT_TARGET
DISTINCT = f"d AS (SELECT min(loan_id) AS loan_id, {CONTENT} FROM borrowers WHERE SeriousDlqin2yrs IS NOT NULL GROUP BY {CONTENT})"
PARTS = f"{DISTINCT}, {SPLIT.replace('FROM borrowers WHERE SeriousDlqin2yrs IS NOT NULL', 'FROM d')}"
TEST_ROWS = "(SELECT count(*) FROM parts WHERE split = 'test')"


def _score_facts(scored, *keys):
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("score").between(0, 1) | F.isnan("score")).alias("outside"))


def _model_facts(name):
    def build(spark, sf_dir):
        scored = cut_lineage(training.score(models.trained(spark, sf_dir, name).model, models.prepared(spark, sf_dir).test))
        auc = evaluation.auc_gini(scored.withColumn("model", F.lit(name))).select(F.col("auc_roc").between(0, 1).alias("auc_in_range"))
        wrong = scored.agg(F.count_if((F.col("score") > 0.5) != (F.col("predicted") == 1)).alias("wrong_class"))
        return _score_facts(scored).crossJoin(F.broadcast(wrong)).crossJoin(F.broadcast(auc))  # one row each

    return build


for _id, _name in zip(("m01", "m02", "m03", "m04"), training.MODELS, strict=True):
    query(f"{_id}_score_facts", f"""
WITH {PARTS} SELECT {TEST_ROWS} AS rows, 0::BIGINT AS outside, 0::BIGINT AS wrong_class, true AS auc_in_range""")(_model_facts(_name))


LEARNS = 0.95


@lru_cache(maxsize=4)
def _taught(spark, sf_dir):
    """Training data whose target follows from the given features: 1 from the age of 60 on."""
    rows = models.feature_table(spark, sf_dir)
    rule = F.coalesce((F.col("age") >= 60).cast("int"), F.lit(0)).cast(rows.schema[TARGET].dataType)
    return training.prepare(rows.withColumn(TARGET, rule), TARGET)


def _taught_facts(name):
    def build(spark, sf_dir):
        data = _taught(spark, sf_dir)
        scored = training.score(training.train_model(name, data, rounds=training.FIRST_ROUNDS).model, data.test).withColumn("model", F.lit(name))
        return evaluation.auc_gini(scored).select("model", (F.col("auc_roc") >= LEARNS).alias("learns"))

    return build


for _id, _name in zip(("m01", "m02", "m03", "m04"), training.MODELS, strict=True):
    query(f"{_id}_learning_facts", f"SELECT '{_name}' AS model, true AS learns")(_taught_facts(_name))


@query("m05_training_facts", "SELECT 4::BIGINT AS models, 4::BIGINT AS timed, 2::BIGINT AS boosted, true AS rounds_in_bounds")
def m05(spark, sf_dir):
    runs = models.m05(spark, sf_dir)
    return runs.agg(F.count(F.lit(1)).alias("models"), F.count_if(F.col("seconds") > 0).alias("timed"), F.count("rounds").alias("boosted"),
                    F.bool_and(F.col("rounds").isNull() | F.col("rounds").between(1, training.BOOSTING_ROUNDS)).alias("rounds_in_bounds"))


@query("m06_score_facts", f"""
WITH {DISTINCT} SELECT unnest(['{"', '".join(training.MODELS)}']) AS model, (SELECT count(*) FROM d) AS rows, 0::BIGINT AS outside""")
def m06(spark, sf_dir):
    return _score_facts(models.m06(spark, sf_dir), "model")


@query("m08_run_facts", "SELECT 4::BIGINT AS models, 1::BIGINT AS best, true AS best_has_highest_auc")
def m08(spark, sf_dir):
    run = cut_lineage(composites.m08(spark, sf_dir))
    return run.agg(F.count(F.lit(1)).alias("models"), F.count_if("is_best").alias("best"),
                   (F.max(F.when(F.col("is_best"), F.col("auc_roc"))) == F.max("auc_roc")).alias("best_has_highest_auc"))


@query("s14_round_trip_facts", f"WITH {PARTS} SELECT {TEST_ROWS} AS rows, 0::BIGINT AS differing")
def s14(spark, sf_dir):
    both = models.s14(spark, sf_dir)
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.abs(F.col("score") - F.col("reloaded")) > 1e-9).alias("differing"))


def _attribution_facts(name, margin):
    """Rows explained, and whether attributions miss the model's output by anything but one constant."""

    def build(spark, sf_dir):
        data, fitted = models.prepared(spark, sf_dir), models.trained(spark, sf_dir, name)
        sums = training.explain(fitted, data).groupBy("row_id").agg(F.sum("shap").alias("explained"), F.count(F.lit(1)).alias("features"))
        scores = training.score(fitted.model, data.test).select(F.col("loan_id").alias("row_id"), "score")
        rest = join_large(scores, sums, "row_id").withColumn("rest", margin(F.col("score")) - F.col("explained"))
        return rest.agg(F.count(F.lit(1)).alias("rows"), (F.max("rest") - F.min("rest") < 1e-6).alias("adds_up"),
                        (F.min("features") == F.max("features")).alias("all_features"))

    return build


def _log_odds(p):
    return F.log(p / (1 - p))


for _id, _name, _margin in (("x02_forest", "Random Forest", lambda p: p), ("x02_boosted", "Gradient Boosting", _log_odds),
                            ("x06_linear", "Logistic Regression", _log_odds)):
    query(f"{_id}_attribution_facts", f"""
WITH {PARTS} SELECT {TEST_ROWS} AS rows, true AS adds_up, true AS all_features""")(_attribution_facts(_name, _margin))


@query("x07_importance_facts", "SELECT 2::BIGINT AS models, 0::BIGINT AS negative, true AS forest_adds_up")
def x07(spark, sf_dir):
    rows = models.x07(spark, sf_dir)
    forest = F.sum(F.when(F.col("model") == "Random Forest", F.col("importance")))
    return rows.agg(F.countDistinct("model").alias("models"), F.count_if(F.col("importance") < 0).alias("negative"),
                    (F.abs(forest - 1) < 1e-6).alias("forest_adds_up"))


@query("a01_isolation_facts", f"WITH {DISTINCT} SELECT count(*) AS rows, 0::BIGINT AS outside FROM d")
def a01(spark, sf_dir):
    return models.a01(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~((F.col("iso_forest_score") > 0) & (F.col("iso_forest_score") <= 1))).alias("outside"))


@query("a03_reconstruction_facts", f"WITH {DISTINCT} SELECT count(*) AS rows, 0::BIGINT AS negative FROM d")
def a03(spark, sf_dir):
    return models.a03(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~(F.col("reconstruction_error") >= 0)).alias("negative"))


def _outlier_facts(fitted, output):
    """How many rows were scored, and whether rows ten deviations away in every feature score above those as they are."""

    def build(spark, sf_dir):
        rows = models.matrix(spark, sf_dir)
        features = cleaning.feature_columns(rows, TARGET)
        deviations = rows.agg(*[F.stddev(F.col(f"`{c}`")).alias(c) for c in features]).first().asDict()
        kept = [F.col(f"`{c}`").cast("double").alias(c) for c in features]
        moved = [(F.col(f"`{c}`").cast("double") + F.lit(10 * (deviations[c] or 1.0))).alias(c) for c in features]
        both = rows.select(*kept, F.lit(0).alias("label")).unionByName(rows.select(*moved, F.lit(1).alias("label")))
        scored = fitted(cleaning.healthy_only(rows, TARGET), features, both)
        scored = cut_lineage(scored.select("label", F.col(output).alias("score"), F.lit("detector").alias("model")))
        auc = evaluation.auc_gini(scored).select((F.col("auc_roc") >= LEARNS).alias("outliers_above"))
        return scored.agg(F.count(F.lit(1)).alias("rows")).crossJoin(F.broadcast(auc))  # one row each

    return build


_TWICE = f"WITH {DISTINCT} SELECT 2 * count(*) AS rows, true AS outliers_above FROM d"
query("a01_outlier_facts", _TWICE)(_outlier_facts(
    lambda healthy, features, rows: isolation.score_isolation(rows, isolation.fit_isolation_forest(healthy, features)), "iso_forest_score"))
query("a03_outlier_facts", _TWICE)(_outlier_facts(
    lambda healthy, features, rows: reconstruction.score_reconstruction(rows, reconstruction.fit_bottleneck(healthy, features)), "reconstruction_error"))


@query("p04_balance_facts", f"""
WITH {PARTS}, sizes AS (SELECT count(*) FILTER (SeriousDlqin2yrs = 1) AS ones, count(*) FILTER (SeriousDlqin2yrs = 0) AS zeros FROM parts WHERE split = 'train')
SELECT greatest(ones, zeros) AS ones, greatest(ones, zeros) AS zeros FROM sizes""")
def p04(spark, sf_dir):
    train = models.prepared(spark, sf_dir).train
    return train.agg(F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros"))


@query("c05_approx_median_facts", f"SELECT unnest(['{"', '".join(COLUMNS)}']) AS feature, true AS within_one_percent")
def c05_approx(spark, sf_dir):
    """Whether at most 51 % of the values lie strictly on either side of each approximate median."""
    rows = cut_lineage(plain(cleaning.drop_duplicate_rows(cleaning.drop_null_target(snapshot(spark, sf_dir), TARGET), "loan_id")))
    return _within_one_percent(rows, cleaning.median_values(rows, COLUMNS, "approx"))


@query("c05_sketch_median_facts", f"SELECT unnest(['{"', '".join(COLUMNS)}']) AS feature, true AS within_one_percent")
def c05_sketch(spark, sf_dir):
    """The same of medians from sketches kept per decade of age, stored in two loads, the second of which rebuilds a decade."""
    rows = cut_lineage(plain(cleaning.drop_duplicate_rows(cleaning.drop_null_target(snapshot(spark, sf_dir), TARGET), "loan_id")))
    parts = rows.withColumn("decade", F.floor(F.col("age") / 10))
    path = scratch_path(spark, "sketches")
    rank_sketches.update_sketches(parts.where("decade <= 5"), COLUMNS, "decade", path)
    rank_sketches.update_sketches(parts.where("decade >= 5 OR decade IS NULL"), COLUMNS, "decade", path)
    return _within_one_percent(rows, rank_sketches.stored_medians(spark, path, COLUMNS))


def _within_one_percent(rows, found):
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"), F.lit(found[c]).alias("median")) for c in COLUMNS]
    sides = rows.select(F.inline(F.array(*entries))).filter("value IS NOT NULL").groupBy("feature").agg(
        F.avg((F.col("value") < F.col("median")).cast("int")).alias("below"), F.avg((F.col("value") > F.col("median")).cast("int")).alias("above"))
    return sides.select("feature", ((F.col("below") <= 0.51) & (F.col("above") <= 0.51)).alias("within_one_percent"))


@query("w01_csv_to_store_exact", composites.SNAPSHOT_EXACT)
def w01(spark, sf_dir):
    """CSV through ingestion with exact medians into the feature store, and back."""
    raw = snapshot(spark, sf_dir).withColumnRenamed("loan_id", "row_id").select(*schemas.snapshot_column_names())
    path, store = scratch_path(spark, "snapshot-csv"), scratch_path(spark, "store")
    raw.write.option("header", True).csv(path)
    table = ingestion.snapshot_table(readers.read_csv(spark, path, schemas.snapshot_schema()), view(spark, sf_dir, "macro_q"), "exact", models.MACRO_QUARTER)
    stored = plain(spark.read.parquet(sinks.write_feature_store(table, "snapshot", store)[0]))
    return stored.withColumn("loan_id", F.col("loan_id").cast("long")).withColumns({f"log_{c}": F.round(f"log_{c}", 6) for c in fx.SNAPSHOT_LOG_COLUMNS})


@query("w03_run_facts", f"WITH {PARTS} SELECT {TEST_ROWS} AS loans, 1::BIGINT AS best_models, 1::BIGINT AS top_features")
def w03(spark, sf_dir):
    return composites.w03(spark, sf_dir).agg(F.sum("loan_count").alias("loans"), F.countDistinct("best_model").alias("best_models"),
                                             F.countDistinct("top_feature").alias("top_features"))


@query("w04_run_facts", f"WITH {DISTINCT} SELECT count(*) AS rows, 0::BIGINT AS wrong_flags FROM d")
def w04(spark, sf_dir):
    either, both = F.col("is_iso_anomaly") | F.col("is_ae_anomaly"), F.col("is_iso_anomaly") & F.col("is_ae_anomaly")
    return composites.w04(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if((F.col("is_ensemble_anomaly") != either) | (F.col("strong_anomaly_flag") != both)).alias("wrong_flags"))


SEQUENCE_LABELS = f"""{BLOCKS}, means AS (SELECT *, (upb_3 + delinq_3) / 2 AS last_mean FROM blocks),
labelled AS (SELECT CASE WHEN last_mean > (SELECT quantile_cont(last_mean, 0.9) FROM means) THEN 1 ELSE 0 END AS label FROM means)"""


@query("q04_sequence_facts", f"WITH {SEQUENCE_LABELS} SELECT label, count(*) AS rows, 0::BIGINT AS outside FROM labelled GROUP BY label")
def q04(spark, sf_dir):
    return _score_facts(models.q04(spark, sf_dir), "label")


@query("w05_sequence_facts", f"WITH {SEQUENCE_LABELS} SELECT label, count(*) AS sequences, true AS in_range FROM labelled GROUP BY label")
def w05(spark, sf_dir):
    return composites.w05(spark, sf_dir).select("label", "sequences", F.col("mean_pd").between(0, 1).alias("in_range"))
