"""Rank sketches kept per partition of a store, so that a refit merges sketches instead of scanning rows.

A sketch table has one row per partition value and one mergeable quantile sketch per column, a few kilobytes each
whatever the number of rows. New or rebuilt partitions replace their own sketches. Medians, caps and cut points over
all partitions, or some, come from the merged sketches; their rank error is about 2.4 / size ** 0.94 (0.4 % at the
default size) and does not grow with the number of merges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendscope.functions import clean_number
from lendscope.operators.cleaning import _c
from lendscope.sources.sinks import write_parquet

SKETCH_SIZE = 1_000


def partition_sketches(df: DataFrame, columns: Sequence[str], partition_by: str, size: int = SKETCH_SIZE) -> DataFrame:
    """One row per value of ``partition_by`` (null included): a sketch of each column's values.

    Nulls, NaN and infinities are left out. Sketches are built in each task and merged, so a partition value that holds
    most rows is no burden. A column without values has an empty sketch.
    """
    if partition_by in columns:
        raise ValueError(f"{partition_by} names the partitions, so it cannot be sketched")
    finite = {c: clean_number(_c(c).cast("double")) for c in columns}
    values = {c: F.when(F.abs(v) < float("inf"), v) for c, v in finite.items()}
    return df.groupBy(_c(partition_by).alias(partition_by)).agg(*[F.kll_sketch_agg_double(v, F.lit(size)).alias(c) for c, v in values.items()])


def update_sketches(df: DataFrame, columns: Sequence[str], partition_by: str, path: str, size: int = SKETCH_SIZE) -> str:
    """Put the sketches of the partitions that ``df`` has at ``path``; sketches of other partitions stay untouched.

    ``df`` has to hold its partitions whole, as :func:`lendscope.sources.sinks.write_parquet` expects as well.
    """
    return write_parquet(partition_sketches(df, columns, partition_by, size), path, "overwrite", partition_by, only_present=True)


def merged_quantiles(sketches: DataFrame, wanted: Mapping[str, tuple[str, float]]) -> DataFrame:
    """One row with a value per name, ``{name: (column, q)}``, over all given sketches; null where there is no value."""
    columns = list(dict.fromkeys(column for column, _ in wanted.values()))
    merged = sketches.agg(*[F.kll_merge_agg_double(_c(c)).alias(c) for c in columns])
    return merged.select(*[
        F.when(F.kll_sketch_get_n_double(_c(c)) > 0, F.kll_sketch_get_quantile_double(_c(c), F.lit(float(q)))).alias(name)
        for name, (c, q) in wanted.items()])


def stored_medians(spark: SparkSession, path: str, columns: Sequence[str]) -> dict[str, float]:
    """Medians of the stored partitions, for ``cleaning.fill_values``; columns without values are left out."""
    row = merged_quantiles(spark.read.parquet(path), {c: (c, 0.5) for c in columns}).first().asDict()
    return {c: v for c, v in row.items() if v is not None}
