"""Sequence classifier over labelled sequences (Q4) and the sequence run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from lendscope import fixed_values as fx
from lendscope.operators import cleaning, sequences
from lendscope.operators.networks import Fitted, Gated, Training, apply, train
from lendscope.operators.sampling import add_class_weight
from lendscope.operators.shared_storage import cut_lineage

TRAINING = Training(epochs=20, batch=128, rate=3e-3, passes=4)


@dataclass(frozen=True)
class SequenceModel:
    """A recurrent network with the scales of its inputs, or a regression over flattened steps."""

    means: tuple[float, ...] = ()
    deviations: tuple[float, ...] = ()
    network: Fitted | None = None
    regression: PipelineModel | None = None


def sequence_features(df: DataFrame, features: Sequence[str], length: int) -> tuple[DataFrame, list[str]]:
    """Every step flattened, and per feature the mean and the slope over the steps."""
    columns = {}
    middle = (length - 1) / 2
    spread = sum((t - middle) ** 2 for t in range(length)) or 1.0
    for i, name in enumerate(features):
        steps = [F.col("steps")[t][i] for t in range(length)]
        for t, step in enumerate(steps):
            columns[f"{name}_{t}"] = step
        columns[f"{name}_mean"] = sum(steps[1:], steps[0]) / length
        columns[f"{name}_slope"] = sum(
            ((t - middle) * s for t, s in enumerate(steps[1:], 1)), -middle * steps[0]
        ) / spread
    return df.withColumns(columns), list(columns)


def _inputs(model: SequenceModel) -> Column:
    """Scaled steps one after the other; a gap counts as the mean."""
    means, deviations = (F.array(*[F.lit(v) for v in x]) for x in (model.means, model.deviations))

    def scaled(step: Column) -> Column:
        known = F.transform(step, lambda v: F.coalesce(cleaning.finite(v), F.lit(None).cast("double")))
        return F.transform(known, lambda v, i: F.coalesce((v - means[i]) / deviations[i], F.lit(0.0)))

    return F.flatten(F.transform("steps", scaled))


def fit_sequence_classifier(labelled: DataFrame, features: Sequence[str], length: int, method: str = "recurrent",
                            training: Training = TRAINING) -> SequenceModel:
    """Fit to all sequences (steps, label).

    ``recurrent``: a gated recurrent unit over the steps, trained by mini-batches in the tasks that hold the sequences.
    ``regression``: logistic regression over the flattened steps with their mean and slope.
    """
    if method == "recurrent":
        each = labelled.select(F.explode("steps").alias("step"))
        values = {i: cleaning.finite(F.col("step")[i]) for i in range(len(features))}
        row = each.agg(*[f(v).alias(f"{n}{i}") for i, v in values.items() for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        scales = SequenceModel(tuple(float(row[f"m{i}"] or 0) for i in values), tuple(float(row[f"s{i}"] or 1) for i in values))
        rows = labelled.select(_inputs(scales).alias("x"), F.col("label").alias("y"))
        return SequenceModel(scales.means, scales.deviations, train(rows, Gated(len(features), length), training))
    if method != "regression":
        raise ValueError(f"unknown method: {method}")
    wide, names = sequence_features(labelled, features, length)
    weighted = add_class_weight(wide, "label")
    rows = weighted.count()
    stages = [
        VectorAssembler(inputCols=names, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(featuresCol="features", labelCol="label", weightCol="class_weight", maxIter=200, regParam=1.0 / max(rows, 1)),
    ]
    return SequenceModel(regression=Pipeline(stages=stages).fit(weighted))


def score_sequences(model: SequenceModel, labelled: DataFrame, features: Sequence[str], length: int, key: str) -> DataFrame:
    """Default probability of every sequence."""
    if model.network:
        return apply(labelled, model.network, _inputs(model), "score").select(key, "seq_no", "label", "score")
    wide, _ = sequence_features(labelled, features, length)
    scored = model.regression.transform(wide).withColumn("score", vector_to_array("probability")[1])
    return scored.select(key, "seq_no", "label", "score")


def sequence_run(df: DataFrame, key: str, order: Sequence[str], features: Sequence[str],
                 length: int = fx.SEQUENCE_LENGTH, method: str = "recurrent") -> DataFrame:
    """Sequences per entity, labels, classifier, and a default probability per sequence."""
    built = cut_lineage(sequences.block_sequences(df, key, order, features, length))
    labelled = cut_lineage(sequences.label_sequences(built))
    model = fit_sequence_classifier(labelled, features, length, method)
    return score_sequences(model, labelled, features, length, key)
