"""Classifier metrics and curves from (model, label, score) rows.

All threshold metrics come from one frame: positives and negatives per distinct score with
running sums. Rows are never ranked one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendscope.functions import rate_metric, safe_ratio
from lendscope.operators.running import GROUP_ROWS, running_counts

THRESHOLD = 0.5
KS_POINTS = 500


def score_counts(df: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", score: str = "score",
                 previous: bool = False, group_rows: int = GROUP_ROWS) -> DataFrame:
    """pos and neg per distinct score, with cum_* (scores up to this one) and total_*."""
    rows = df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    measures = {"pos": F.col(label).cast("long"), "neg": (1 - F.col(label)).cast("long")}
    return running_counts(rows, keys, score, measures, previous, group_rows)


def _auc() -> Column:
    """Share of (positive, negative) pairs in the right order, half for ties."""
    below = F.col("cum_neg") - F.col("neg") / 2
    pairs = F.first("total_pos").cast("double") * F.first("total_neg")
    return safe_ratio(F.sum(F.col("pos") * below), pairs)


def _ks() -> Column:
    return F.max(F.abs(safe_ratio(F.col("cum_pos"), F.col("total_pos")) - safe_ratio(F.col("cum_neg"), F.col("total_neg"))))


def _at_or_above(kind: str) -> Column:
    return F.col(f"total_{kind}") - F.col(f"cum_{kind}") + F.col(kind)


def _is_top() -> Column:
    """Marks the highest score of a group."""
    return (F.col("cum_pos") == F.col("total_pos")) & (F.col("cum_neg") == F.col("total_neg"))


def _average_precision() -> Column:
    tp, fp = _at_or_above("pos"), _at_or_above("neg")
    return F.sum(safe_ratio(F.col("pos"), F.col("total_pos")) * tp / (tp + fp))


def auc_gini(df: DataFrame, keys: Sequence[str] = ("model",), **names) -> DataFrame:
    return score_counts(df, keys, **names).groupBy(*keys).agg(_auc().alias("auc_roc")).withColumn(
        "gini", 2 * F.col("auc_roc") - 1
    )


def ks_statistic(df: DataFrame, keys: Sequence[str] = ("model",), **names) -> DataFrame:
    return score_counts(df, keys, **names).groupBy(*keys).agg(_ks().alias("ks_statistic"))


def average_precision(df: DataFrame, keys: Sequence[str] = ("model",), **names) -> DataFrame:
    return score_counts(df, keys, **names).groupBy(*keys).agg(_average_precision().alias("pr_auc"))


def confusion_counts(df: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", score: str = "score",
                     threshold: float = THRESHOLD) -> DataFrame:
    """Counts at the threshold; a score equal to it is predicted negative."""
    predicted, actual = F.col(score) > threshold, F.col(label) == 1
    return df.groupBy(*keys).agg(
        F.count_if(~actual & ~predicted).alias("true_negatives"),
        F.count_if(~actual & predicted).alias("false_positives"),
        F.count_if(actual & ~predicted).alias("false_negatives"),
        F.count_if(actual & predicted).alias("true_positives"),
    )


def label_rates(confusion: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1; 0 where undefined."""
    tp, tn = F.col("true_positives"), F.col("true_negatives")
    fp, fn = F.col("false_positives"), F.col("false_negatives")
    return confusion.withColumns({
        "accuracy": safe_ratio(tp + tn, tp + tn + fp + fn, 0.0),
        "precision": safe_ratio(tp, tp + fp, 0.0),
        "recall": safe_ratio(tp, tp + fn, 0.0),
        "f1_score": safe_ratio(2 * tp, 2 * tp + fp + fn, 0.0),
    })


METRIC_ORDER = (
    "auc_roc", "gini", "ks_statistic", "pr_auc", "f1_score", "accuracy",
    "true_positives", "true_negatives", "false_positives", "false_negatives", "precision", "recall",
)


def model_comparison(df: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", score: str = "score",
                     threshold: float = THRESHOLD) -> DataFrame:
    """All metrics of all models from a single pass over the scores."""
    counts = score_counts(df, keys, label, score)
    above = F.col(score) > threshold
    summed = counts.groupBy(*keys).agg(
        _auc().alias("auc_roc"), _ks().alias("ks_statistic"), _average_precision().alias("pr_auc"),
        F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("true_positives"),
        F.sum(F.when(above, 0).otherwise(F.col("neg"))).alias("true_negatives"),
        F.sum(F.when(above, F.col("neg")).otherwise(0)).alias("false_positives"),
        F.sum(F.when(above, 0).otherwise(F.col("pos"))).alias("false_negatives"),
    )
    rated = label_rates(summed.withColumn("gini", 2 * F.col("auc_roc") - 1))
    return rated.select(*keys, *METRIC_ORDER)


def roc_points(df: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", score: str = "score",
               drop_collinear: bool = True, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(fpr, tpr, threshold) from (0, 0) at infinity down to the lowest score.

    ``drop_collinear`` leaves out points whose step equals the next one, as they lie on a line.
    """
    counts = score_counts(df, keys, label, score, previous=True, group_rows=group_rows)
    tp, fp = _at_or_above("pos"), _at_or_above("neg")
    if drop_collinear:
        last = F.col("prev_pos").isNull()
        bend = (F.col("prev_pos") != F.col("pos")) | (F.col("prev_neg") != F.col("neg"))
        counts = counts.filter(_is_top() | last | bend)
    point = F.struct(
        safe_ratio(fp, F.col("total_neg")).alias("fpr"), safe_ratio(tp, F.col("total_pos")).alias("tpr"),
        F.col(score).alias("threshold"),
    )
    origin = F.struct(F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"), F.lit(float("inf")).alias("threshold"))
    return counts.select(*keys, F.inline(F.when(_is_top(), F.array(origin, point)).otherwise(F.array(point))))


def precision_recall_points(df: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", score: str = "score") -> DataFrame:
    """(precision, recall, threshold) per distinct score, and the end point (1, 0)."""
    tp, fp = _at_or_above("pos"), _at_or_above("neg")
    point = F.struct(
        (tp / (tp + fp)).alias("precision"), safe_ratio(tp, F.col("total_pos")).alias("recall"), F.col(score).alias("threshold")
    )
    end = F.struct(F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), F.lit(None).cast("double").alias("threshold"))
    counts = score_counts(df, keys, label, score)
    return counts.select(*keys, F.inline(F.when(_is_top(), F.array(end, point)).otherwise(F.array(point))))


def _grid_cell(score: Column, points: int) -> Column:
    """Index of the lowest grid point i / (points - 1) that is >= the score."""
    step = 1.0 / (points - 1)
    guess = F.ceil(score * float(points - 1))
    lower = F.when((guess - 1) * F.lit(step) >= score, guess - 1).otherwise(guess)
    return F.greatest(F.when(lower * F.lit(step) < score, lower + 1).otherwise(lower), F.lit(0))


def ks_curve(df: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", score: str = "score",
             points: int = KS_POINTS) -> DataFrame:
    """Both score distributions on an even grid over [0, 1], and their gap."""
    keys = list(keys)
    rows = df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    cells = rows.groupBy(*keys, _grid_cell(F.col(score), points).alias("cell")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg")
    )
    grid = cells.select(*keys).distinct().select(*keys, F.explode(F.expr(f"sequence(0L, {points - 1}L)")).alias("cell"))
    upto = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    group = Window.partitionBy(*keys)
    summed = grid.join(cells, [*keys, "cell"], "full").select(
        *keys, "cell",
        *[F.coalesce(F.sum(m).over(upto), F.lit(0)).alias(f"cum_{m}") for m in ("pos", "neg")],
        *[F.sum(m).over(group).alias(f"total_{m}") for m in ("pos", "neg")],
    ).filter(F.col("cell") < points)
    default = safe_ratio(F.col("cum_pos"), F.col("total_pos"))
    healthy = safe_ratio(F.col("cum_neg"), F.col("total_neg"))
    return summed.select(
        *keys, F.col("cell").cast("int").alias("point"),
        F.when(F.col("cell") == points - 1, F.lit(1.0)).otherwise(F.col("cell") * F.lit(1.0 / (points - 1))).alias("threshold"),
        default.alias("cdf_default"), healthy.alias("cdf_non_default"), F.abs(default - healthy).alias("gap"),
    )


def ks_point(curve: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """First grid point with the widest gap."""
    best = F.max_by(F.struct("point", "threshold", "gap"), F.struct("gap", -F.col("point")))
    return curve.groupBy(*keys).agg(best.alias("best")).select(*keys, "best.*")


def best_model(metrics: DataFrame, by: str = "auc_roc", name: str = "model", within: Sequence[str] = ()) -> DataFrame:
    """The row with the highest metric (first name on ties), per group if given; one aggregate, no job.

    A missing metric loses against any other.
    """
    columns = [c for c in metrics.columns if c not in within]
    place = F.struct(-F.coalesce(F.nanvl(F.col(by).cast("double"), F.lit(None)), F.lit(float("-inf"))), F.col(name))
    picked = metrics.groupBy(*within).agg(F.min_by(F.struct(*columns), place).alias("best"))
    return picked.filter(F.col("best").isNotNull()).select(*within, "best.*")


def rated_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        "model", "auc_roc", rate_metric("auc_roc", "auc_roc").alias("auc_rating"),
        "gini", rate_metric("gini", "gini").alias("gini_rating"),
        "ks_statistic", rate_metric("ks_statistic", "ks_statistic").alias("ks_rating"),
    )
