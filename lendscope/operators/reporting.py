"""Report frames over metrics, importances and portfolio results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lendscope import fixed_values as fx
from lendscope.operators.attribution import top_features
from lendscope.operators.evaluation import METRIC_ORDER, best_model, rated_metrics


def competing_models(metrics: DataFrame, name: str = "model") -> DataFrame:
    """All models but the best, with AUC and KS."""
    best = best_model(metrics).select(name)
    return metrics.join(best, name, "left_anti").select(name, "auc_roc", "ks_statistic")


def _beside(*frames: DataFrame) -> DataFrame:
    """Single-row frames as one row: stacked with missing columns as null, then collapsed."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])


def key_figures(summary: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row: loans, EAD, EL, EL %, and the best model's AUC and KS."""
    portfolio = summary.select("total_loans", "total_ead", "total_expected_loss", "el_as_pct_of_ead")
    best = best_model(metrics).select(
        F.col("model").alias("best_model"), F.col("auc_roc").alias("best_auc"), F.col("ks_statistic").alias("best_ks")
    )
    return _beside(portfolio, best)


def radar(metrics: DataFrame) -> DataFrame:
    """Six metrics of the best model in long form."""
    names = fx.RADAR_METRICS
    best = best_model(metrics).select("model", *[F.col(c).alias(label) for c, label in names.items()])
    return best.unpivot(["model"], list(names.values()), "metric", "value")


CARD_TEXTS = {
    "model_type": "binary classifier of default",
    "class_imbalance_handling": "synthetic minority rows, balanced weights",
    "split_strategy": "70/15/15 by class",
    "selection_criteria": "largest test AUC",
}


def model_card(metrics: DataFrame, importance: DataFrame, summary: DataFrame, dataset: str, target: str,
               texts: Mapping[str, str] = CARD_TEXTS) -> DataFrame:
    """The model card as one nested record with its JSON text; ``texts`` are its fixed sentences."""
    best = best_model(metrics)
    header = best.select(
        F.col("model").alias("algorithm"),
        F.struct(*METRIC_ORDER).alias("performance_metrics"),
    )
    others = competing_models(metrics).agg(
        F.sort_array(F.collect_list(F.struct("model", "auc_roc", F.col("ks_statistic").alias("ks")))).alias("competing_models")
    )
    ranked = top_features(importance, 5).agg(
        F.sort_array(F.collect_list(F.struct("rank", "feature", "mean_abs_shap"))).alias("top_features")
    )
    used = importance.agg(F.count(F.lit(1)).alias("features_used"))
    losses = summary.select(F.struct(*summary.columns).alias("expected_loss_summary"))
    card = _beside(header, others, ranked, used, losses).select(
        F.concat(F.lit(f"{dataset} PD model: "), "algorithm").alias("model_name"),
        F.lit(texts["model_type"]).alias("model_type"),
        F.lit(dataset).alias("dataset"),
        F.struct(
            "features_used", F.lit(target).alias("target_variable"),
            F.lit(texts["class_imbalance_handling"]).alias("class_imbalance_handling"),
            F.lit(texts["split_strategy"]).alias("split_strategy"),
        ).alias("training_data"),
        F.struct("algorithm", F.lit(texts["selection_criteria"]).alias("selection_criteria")).alias("model_architecture"),
        "performance_metrics", "competing_models", "top_features", "expected_loss_summary",
    )
    return card.withColumn("card_json", F.to_json(F.struct(*card.columns)))


def validation_rows(metrics: DataFrame, importance: DataFrame, summary: DataFrame) -> DataFrame:
    """Report content as (section, item, value, note) rows."""
    rated = rated_metrics(best_model(metrics))
    executive = rated.select(F.inline(F.array(
        _line("executive", "best_model", F.lit(None), F.col("model")),
        _line("executive", "auc_roc", F.col("auc_roc"), F.col("auc_rating")),
        _line("executive", "gini", F.col("gini"), F.col("gini_rating")),
        _line("executive", "ks_statistic", F.col("ks_statistic"), F.col("ks_rating")),
    )))
    selection = metrics.select(_line("selection", "auc_roc", F.col("auc_roc"), F.col("model")).alias("r")).select("r.*")
    detail = best_model(metrics).select(F.inline(F.array(
        *[_line("performance", m, F.col(m), F.lit(None)) for m in METRIC_ORDER]
    )))
    features = top_features(importance, 5).select(
        _line("features", "rank", F.col("mean_abs_shap"), F.concat_ws(" ", "rank", "feature")).alias("r")
    ).select("r.*")
    losses = summary.select(F.inline(F.array(*[_line("expected_loss", c, F.col(c), F.lit(None)) for c in summary.columns])))
    return executive.unionByName(selection).unionByName(detail).unionByName(features).unionByName(losses)


def _line(section: str, item: str, value, note):
    return F.struct(
        F.lit(section).alias("section"), F.lit(item).alias("item"),
        value.cast("double").alias("value"), note.cast("string").alias("note"),
    )


def report_markdown(title: str, rows) -> str:
    """Collected :func:`validation_rows` as Markdown tables, one per section."""
    lines = [f"# {title}"]
    section = None
    for r in rows:
        if r["section"] != section:
            section = r["section"]
            lines += ["", f"## {section}", "", "| item | value | note |", "| --- | --- | --- |"]
        value = "" if r["value"] is None else f"{r['value']:.4f}"
        lines.append(f"| {r['item']} | {value} | {r['note'] or ''} |")
    return "\n".join(lines) + "\n"


def project_status(metrics: DataFrame) -> DataFrame:
    """Best model and AUC per dataset, from metric rows with a dataset column."""
    return best_model(metrics, within=["dataset"]).select("dataset", F.col("model").alias("best_model"), "auc_roc")
