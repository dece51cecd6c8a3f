"""Reconstruction error through a bottleneck (A3): a network trained on healthy rows, or their principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from lendscope import fixed_values as fx
from lendscope.operators.networks import Autoencoder, Fitted, Training, apply, train
from lendscope.operators.sampling import Scaler, fit_scaler, scale

TRAINING = Training(epochs=50, batch=256, rate=1e-3, decay=1e-5, patience=5)


@dataclass(frozen=True)
class Bottleneck:
    """Scaling of the inputs, and the component directions (features x k) or the fitted network."""

    scaler: Scaler
    components: tuple[tuple[float, ...], ...] = ()
    network: Fitted | None = None


def _scaled_vector(scaler: Scaler) -> Column:
    """Scaled inputs as one array; a gap counts as the mean."""
    columns = [scaler.scaled(c) for c in scaler.means]
    return F.array(*[F.when(F.isnan(c) | c.isNull(), 0.0).otherwise(c) for c in columns])


def fit_bottleneck(df: DataFrame, features: Sequence[str], k: int = fx.BOTTLENECK, method: str = "network",
                   training: Training = TRAINING) -> Bottleneck:
    """Fit to all rows of ``df``, which should be healthy ones.

    ``network``: an encoder and decoder of widths 32 and 16 around ``k`` numbers, trained by mini-batches in the tasks that hold
    the rows. ``linear``: principal components, the best such code without curvature.
    """
    features = list(features)
    scaler = fit_scaler(df, features)
    if method == "network":
        rows = df.select(_scaled_vector(scaler).alias("x"), F.lit(0.0).alias("y"))
        return Bottleneck(scaler, network=train(rows, Autoencoder(len(features), bottleneck=k), training))
    if method != "linear":
        raise ValueError(f"unknown method: {method}")
    assembled = VectorAssembler(inputCols=features, outputCol="_x").transform(scale(df.select(*[F.col(f"`{c}`") for c in features]), scaler))
    model = PCA(k=min(k, len(features)), inputCol="_x", outputCol="_p").fit(assembled)
    return Bottleneck(scaler, tuple(tuple(map(float, row)) for row in model.pc.toArray()))


def score_reconstruction(df: DataFrame, bottleneck: Bottleneck, output: str = "reconstruction_error") -> DataFrame:
    """Mean squared error per row. For components that is (|z|^2 - |projection|^2) / features, all as column expressions."""
    if bottleneck.network:
        return apply(df, bottleneck.network, _scaled_vector(bottleneck.scaler), output)
    features = list(bottleneck.scaler.means)
    z = F.array(*[bottleneck.scaler.scaled(c) for c in features])
    dims = len(bottleneck.components[0])
    directions = F.array(*[F.array(*[F.lit(row[j]) for row in bottleneck.components]) for j in range(dims)])

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)

    staged = df.withColumn("_z", z)
    kept = F.aggregate(F.transform(directions, lambda d: dot(d, F.col("_z"))), F.lit(0.0), lambda t, p: t + p * p)
    error = (dot(F.col("_z"), F.col("_z")) - kept) / len(features)
    return staged.withColumn(output, F.greatest(error, F.lit(0.0))).drop("_z")
