"""Fixed-length row sequences per entity (Q1-Q3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from lendscope import fixed_values as fx
from lendscope.operators.quantiles import exact_quantiles
from lendscope.operators.running import GROUP_ROWS, number_rows

LABEL_QUANTILE = 0.9
CHUNK_ROWS = 100_000


def _steps(order: Sequence[str], features: Sequence[str]):
    return F.struct(F.col("row_no"), *[F.col(c).cast("double").alias(c) for c in features])


def block_sequences(df: DataFrame, key: str, order: Sequence[str], features: Sequence[str],
                    length: int = fx.SEQUENCE_LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Non-overlapping sequences of ``length`` rows per key; an incomplete tail is dropped.

    Columns: key, seq_no (0-based) and steps, an array of feature arrays in order.
    """
    if length < 1:
        raise ValueError("sequence length has to be positive")
    numbered = number_rows(df.select(key, *dict.fromkeys([*order, *features])), key, order, group_rows=group_rows)
    placed = numbered.withColumn("seq_no", F.floor((F.col("row_no") - 1) / length).cast("long"))
    gathered = placed.groupBy(key, "seq_no").agg(F.sort_array(F.collect_list(_steps(order, features))).alias("rows"))
    return gathered.filter(F.size("rows") == length).select(key, "seq_no", _feature_arrays(features).alias("steps"))


def sliding_sequences(df: DataFrame, key: str, order: Sequence[str], features: Sequence[str],
                      length: int = fx.SEQUENCE_LENGTH, group_rows: int = GROUP_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Every full window of ``length`` consecutive rows per key; end_no is its last row number.

    Each key is cut into chunks of consecutive rows. The last rows of a chunk are repeated as
    lead-in of the next, so windows never reach over chunks and one key can use many tasks.
    """
    numbered = number_rows(df.select(key, *dict.fromkeys([*order, *features])), key, order, group_rows=group_rows)
    chunk = F.floor((F.col("row_no") - 1) / chunk_rows).cast("long")
    tail = (F.col("row_no") - 1) % chunk_rows >= chunk_rows - (length - 1)
    places = F.when(tail, F.array(F.struct(chunk.alias("chunk"), F.lit(True).alias("own")),
                                  F.struct((chunk + 1).alias("chunk"), F.lit(False).alias("own"))))
    places = places.otherwise(F.array(F.struct(chunk.alias("chunk"), F.lit(True).alias("own"))))
    placed = numbered.select("*", F.inline(places))
    frame = Window.partitionBy(key, "chunk").orderBy("row_no").rowsBetween(-(length - 1), 0)
    windows = placed.withColumn("rows", F.collect_list(_steps(order, features)).over(frame))
    full = windows.filter(F.col("own") & (F.size("rows") == length))
    return full.select(key, F.col("row_no").alias("end_no"), _feature_arrays(features).alias("steps"))


def _feature_arrays(features: Sequence[str]):
    return F.transform("rows", lambda r: F.array(*[r[c] for c in features]))


def last_step_mean(steps: str = "steps"):
    last = F.element_at(steps, -1)
    return F.aggregate(last, F.lit(0.0), lambda total, x: total + x) / F.size(last)


def label_sequences(sequences: DataFrame, quantile: float = LABEL_QUANTILE) -> DataFrame:
    """Label 1 where the mean of the last step exceeds the batch quantile."""
    scored = sequences.withColumn("last_mean", last_step_mean())
    cut = exact_quantiles(scored, {"cut": (F.col("last_mean"), quantile)})["cut"]
    if cut is None:
        raise ValueError("not enough rows for one sequence")
    return scored.withColumn("label", (F.col("last_mean") > F.lit(cut)).cast("int"))
