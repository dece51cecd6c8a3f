"""Declared schemas as Spark types (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from lendscope import fixed_values as fx

_TYPES = {"int": IntegerType(), "bigint": LongType(), "double": DoubleType(), "string": StringType()}


def _struct(fields) -> StructType:
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in fields])


def snapshot_schema() -> StructType:
    return _struct(fx.SNAPSHOT_FIELDS)


def loan_book_schema() -> StructType:
    return _struct(fx.LOAN_BOOK_FIELDS)


def monthly_performance_schema() -> StructType:
    return _struct(fx.MONTHLY_FIELDS)


def macro_schema() -> StructType:
    return _struct(fx.MACRO_FIELDS)


def snapshot_column_names() -> list[str]:
    return snapshot_schema().fieldNames()


def conformity(df: DataFrame, schema: StructType) -> DataFrame:
    """Per declared column: position, type, and the values of the data that fit the type.

    Text that fits is counted by a cast that gives null on bad text; absent columns count 0.
    """
    fits = [
        F.count(F.col(f"`{f.name}`").cast("string").try_cast(f.dataType.simpleString())).alias(f.name)
        for f in schema.fields if f.name in df.columns
    ]
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *fits)
    entries = [
        F.struct(F.lit(f.name).alias("column"), F.lit(i).alias("position"), F.lit(f.dataType.simpleString()).alias("type"),
                 (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(0).cast("long")).alias("fitting"))
        for i, f in enumerate(schema.fields)
    ]
    return counted.select(F.inline(F.array(*entries)))
