"""Feature tables over a stream of files, with values fitted on a batch.

The feature operators are row expressions once their medians, scales and dates are known, so
the batch code runs on a stream unchanged and keeps no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lendscope import fixed_values as fx
from lendscope.operators import cleaning
from lendscope.operators.features import FeatureFit, loan_book_features, snapshot_features


def csv_stream(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """New CSV files of a folder under a declared schema."""
    return spark.readStream.option("header", True).schema(schema).csv(folder)


def snapshot_stream(raw: DataFrame, fit: FeatureFit) -> DataFrame:
    labelled = cleaning.drop_null_target(cleaning.rename_id(raw), fx.SNAPSHOT_TARGET)
    return snapshot_features(labelled, fit)


def loan_book_stream(raw: DataFrame, fit: FeatureFit) -> DataFrame:
    labelled = cleaning.encode_target(cleaning.keep_labelled(raw))
    return loan_book_features(cleaning.percent_columns(labelled), fit)


def append_parquet(features: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write everything available now, exactly once per input file, and stop."""
    writer = features.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).start(path)
