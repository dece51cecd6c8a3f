"""Small networks trained where the rows are: each task steps through its rows, parameters are averaged between rounds.

A round sends the parameters and the optimizer's moments to all tasks. A task makes mini-batch steps over its own rows
and returns one row: its parameters times its number of rows. These are added in a tree of tasks, so the driver gets few
rows of the size of the network, whatever the number of tasks. Rows never leave the executors.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.storagelevel import StorageLevel

from lendscope import fixed_values as fx

# Workers get these functions by value, so they need numpy and pyarrow but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TASK_ROWS = 20_000
FAN_IN = 64
_BETAS = (0.9, 0.999)


@dataclass(frozen=True)
class Training:
    """``epochs`` passes over all rows, ``passes`` of them between two averages; the rate halves after ``patience`` passes without gain."""

    epochs: int
    batch: int
    rate: float
    decay: float = 0.0
    passes: int = 5
    patience: int | None = None
    seed: int = fx.SEED


@dataclass(frozen=True)
class Gated:
    """A gated recurrent unit over the steps of a sequence, a rectified layer, and the log-odds of class 1."""

    inputs: int
    steps: int
    hidden: int = 32
    dense: int = 16

    def start(self, rng: np.random.Generator) -> list[np.ndarray]:
        def uniform(n, *shape):
            return rng.uniform(-1, 1, shape) / math.sqrt(n)

        h = self.hidden
        return [uniform(h, self.inputs, 3 * h), uniform(h, h, 3 * h), np.zeros(3 * h), np.zeros(h),
                uniform(h, h, self.dense), np.zeros(self.dense), uniform(self.dense, self.dense, 1), np.zeros(1)]

    def _run(self, p: list[np.ndarray], x: np.ndarray):
        w, u, b, c = p[:4]
        h, n = self.hidden, len(x)
        x = x.reshape(n, self.steps, self.inputs)
        state, kept = np.zeros((n, h)), []
        for t in range(self.steps):
            a, r = x[:, t] @ w + b, state @ u
            gates = 1 / (1 + np.exp(-np.clip(a[:, : 2 * h] + r[:, : 2 * h], -60, 60)))
            update, reset = gates[:, :h], gates[:, h:]
            inner = r[:, 2 * h :] + c
            new = np.tanh(a[:, 2 * h :] + reset * inner)
            kept.append((x[:, t], state, update, reset, inner, new))
            state = update * state + (1 - update) * new
        layer = state @ p[4] + p[5]
        out = np.maximum(layer, 0) @ p[6] + p[7]
        return kept, state, layer, out[:, 0]

    def gradients(self, p: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Summed log loss of the rows, and the gradients of its mean."""
        kept, state, layer, out = self._run(p, x)
        loss = float(np.sum(np.logaddexp(0, out) - y * out))
        d_out = ((1 / (1 + np.exp(-np.clip(out, -60, 60)))) - y)[:, None] / len(x)
        rectified = np.maximum(layer, 0)
        d_layer = (d_out @ p[6].T) * (layer > 0)
        g = [np.zeros_like(v) for v in p]
        g[6], g[7], g[4], g[5] = rectified.T @ d_out, d_out.sum(0), state.T @ d_layer, d_layer.sum(0)
        d_state = d_layer @ p[4].T
        for step, before, update, reset, inner, new in reversed(kept):
            d_new = d_state * (1 - update) * (1 - new * new)
            d_update = d_state * (before - new) * update * (1 - update)
            d_reset = d_new * inner * reset * (1 - reset)
            d_input = np.concatenate([d_update, d_reset, d_new], axis=1)
            d_carried = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
            g[0] += step.T @ d_input
            g[1] += before.T @ d_carried
            g[2] += d_input.sum(0)
            g[3] += (d_new * reset).sum(0)
            d_state = d_state * update + d_carried @ p[1].T
        return loss, g

    def output(self, p: list[np.ndarray], x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._run(p, x)[3], -60, 60)))


@dataclass(frozen=True)
class Autoencoder:
    """Dense layers down to a bottleneck and up again; exponential linear units but at the bottleneck and the end."""

    inputs: int
    widths: tuple[int, ...] = (32, 16)
    bottleneck: int = fx.BOTTLENECK

    def _sizes(self) -> list[int]:
        return [self.inputs, *self.widths, self.bottleneck, *reversed(self.widths), self.inputs]

    def start(self, rng: np.random.Generator) -> list[np.ndarray]:
        sizes, p = self._sizes(), []
        for a, b in zip(sizes[:-1], sizes[1:], strict=True):
            p += [rng.uniform(-1, 1, (a, b)) / math.sqrt(a), rng.uniform(-1, 1, b) / math.sqrt(a)]
        return p

    def _run(self, p: list[np.ndarray], x: np.ndarray) -> list[np.ndarray]:
        found, layers = [x], len(p) // 2
        for k in range(layers):
            z = found[-1] @ p[2 * k] + p[2 * k + 1]
            if k not in (len(self.widths), layers - 1):
                z = np.where(z > 0, z, np.expm1(np.minimum(z, 0)))
            found.append(z)
        return found

    def gradients(self, p: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Summed squared error per feature of the rows, and the gradients of its mean. ``y`` is not used."""
        found, layers = self._run(p, x), len(p) // 2
        off = found[-1] - x
        d, g = 2 * off / off.size, [np.empty(0)] * len(p)
        for k in reversed(range(layers)):
            if k not in (len(self.widths), layers - 1):
                z = found[k + 1]
                d = d * np.where(z > 0, 1, z + 1)
            g[2 * k], g[2 * k + 1] = found[k].T @ d, d.sum(0)
            d = d @ p[2 * k].T
        return float((off * off).mean(axis=1).sum()), g

    def output(self, p: list[np.ndarray], x: np.ndarray) -> np.ndarray:
        """Mean squared error of each row."""
        off = self._run(p, x)[-1] - x
        return (off * off).mean(axis=1)


@dataclass
class Fitted:
    """A network's shape, its parameters, and the mean loss of the rows in each round of training."""

    network: Gated | Autoencoder
    parameters: list[np.ndarray]
    losses: list[float] = field(default_factory=list)

    def save(self, spark: SparkSession, path: str) -> str:
        rows = [(i, list(map(int, p.shape)), p.ravel().tolist()) for i, p in enumerate(self.parameters)]
        spark.createDataFrame(rows, "number int, shape array<int>, numbers array<double>").coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @classmethod
    def load(cls, spark: SparkSession, network: Gated | Autoencoder, path: str) -> Fitted:
        rows = spark.read.parquet(path).orderBy("number").collect()
        return cls(network, [np.array(r["numbers"]).reshape(r["shape"]) for r in rows])


def _flat(arrays: Sequence[np.ndarray]) -> np.ndarray:
    return np.concatenate([a.ravel() for a in arrays])


def _shaped(flat: np.ndarray, like: Sequence[np.ndarray]) -> list[np.ndarray]:
    cuts = np.cumsum([a.size for a in like])[:-1]
    return [part.reshape(a.shape) for part, a in zip(np.split(flat, cuts), like, strict=True)]


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten(), np.float64).reshape(-1, width)


def _steps(network, shared, width: int, settings: Training, number: int):
    """Mini-batch steps over the rows of one task: (rows, loss, parameters and moments times rows)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        x, y = _matrix(table.column("x"), width), table.column("y").to_numpy()
        flat, first, second, step, rate = shared.value
        like = network.start(np.random.default_rng(0))
        flat, first, second = flat.copy(), first.copy(), second.copy()
        rng = np.random.default_rng((settings.seed, number, TaskContext.get().partitionId()))
        loss = 0.0
        for _ in range(settings.passes):
            order, loss = rng.permutation(len(x)), 0.0
            for at in range(0, len(x), settings.batch):
                some = order[at : at + settings.batch]
                part, gradients = network.gradients(_shaped(flat, like), x[some], y[some])
                g = _flat(gradients) + settings.decay * flat
                loss, step = loss + part, step + 1
                first = _BETAS[0] * first + (1 - _BETAS[0]) * g
                second = _BETAS[1] * second + (1 - _BETAS[1]) * g * g
                flat -= rate * (first / (1 - _BETAS[0] ** step)) / (np.sqrt(second / (1 - _BETAS[1] ** step)) + 1e-8)
        blob = (np.concatenate([flat, first, second]) * len(x)).tobytes()
        yield pa.RecordBatch.from_pydict({"n": [len(x)], "loss": [loss], "step": [step * len(x)], "blob": [blob]})

    return work


_SUMS = "n long, loss double, step long, blob binary"


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n, loss, step = None, 0, 0.0, 0
    for batch in batches:
        for row in batch.to_pylist():
            values = np.frombuffer(row["blob"])
            total = values.copy() if total is None else total + values
            n, loss, step = n + row["n"], loss + row["loss"], step + row["step"]
    if total is not None:
        yield pa.RecordBatch.from_pydict({"n": [n], "loss": [loss], "step": [step], "blob": [total.tobytes()]})


def train(rows: DataFrame, network: Gated | Autoencoder, settings: Training) -> Fitted:
    """Fit ``network`` to ``rows`` of (x array<double>, y double).

    Rows are dealt evenly over tasks of TASK_ROWS, so a task's share fits its memory and equal rows cannot pile up in
    one. An empty table raises, as there is nothing to fit.
    """
    spark = rows.sparkSession
    total = rows.count()
    if not total:
        raise ValueError("no rows to train on")
    tasks = -(-total // TASK_ROWS)
    width = len(rows.select("x").first()["x"])
    dealt = rows.select("x", F.col("y").cast("double").alias("y")).repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    like = network.start(np.random.default_rng(settings.seed))
    flat = _flat(like)
    first, second, step, rate = np.zeros_like(flat), np.zeros_like(flat), 0, settings.rate
    losses: list[float] = []
    best, waited = math.inf, 0
    try:
        for number in range(-(-settings.epochs // settings.passes)):
            shared = spark.sparkContext.broadcast((flat, first, second, step, rate))
            sums, left = dealt.mapInArrow(_steps(network, shared, width, settings, number), _SUMS), tasks
            while left > FAN_IN:
                left = -(-left // FAN_IN)
                sums = sums.repartition(left).mapInArrow(_added, _SUMS)
            parts = sums.collect()
            n = sum(r["n"] for r in parts)
            flat, first, second = np.split(sum(np.frombuffer(bytes(r["blob"])) for r in parts) / n, 3)
            step = round(sum(r["step"] for r in parts) / n)
            losses.append(sum(r["loss"] for r in parts) / n)
            shared.destroy()
            waited = 0 if losses[-1] < best * (1 - 1e-4) else waited + settings.passes
            best = min(best, losses[-1])
            if settings.patience and waited > settings.patience:
                rate, waited = rate / 2, 0
        return Fitted(network, _shaped(flat, like), losses)
    finally:
        dealt.unpersist()


def apply(df: DataFrame, fitted: Fitted, x: Column, output: str) -> DataFrame:
    """``df`` with the network's output for the vector ``x`` of each row, Arrow batch by batch."""
    network, parameters = fitted.network, fitted.parameters

    @F.pandas_udf("double")
    def out(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            yield pd.Series(network.output(parameters, np.stack(vectors.to_numpy())) if len(vectors) else [], dtype=float)

    return df.withColumn(output, out(x))
