"""CSV, Parquet and artifact readers.

A missing path is reported by Spark itself (``AnalysisException``, PATH_NOT_FOUND) on any
file system, so no local existence test is made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from lendscope import fixed_values as fx
from lendscope.functions import to_number
from lendscope.sources import schemas


def read_csv(spark: SparkSession, path: str, declared: StructType | None = None, **options) -> DataFrame:
    """CSV with a header line. Columns have the declared types; without a declaration they are text.

    ``options`` are those of Spark's CSV source, such as ``header=False`` or ``inferSchema=True``.
    """
    return spark.read.csv(path, schema=declared, **{"header": True, **options})


def read_csv_as_numbers(spark: SparkSession, path: str, numeric: Sequence[str]) -> DataFrame:
    """CSV read as text with chosen columns coerced, so one bad cell cannot retype a column.

    Reads the file once, where schema inference reads it twice.
    """
    df = read_csv(spark, path)
    return df.withColumns({c: to_number(c) for c in numeric if c in df.columns})


def column_contract(df: DataFrame, expected: Sequence[str], target: str) -> tuple[DataFrame, list[str]]:
    """Project to the expected columns that exist (target always kept); also the missing ones."""
    held = {field.name: F.col(f"`{field.name}`") for field in df.schema}
    wanted = dict.fromkeys([*expected, target])
    return df.select(*[held[c] for c in wanted if c in held or c == target]), [c for c in expected if c not in held]


def contract_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """One row per expected column: its presence and how many of its values are filled."""
    present = [c for c in expected if c in df.columns]
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in present], F.lit(1).alias("_one"))
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(c in present).alias("present"),
                 (F.col(f"`{c}`") if c in present else F.lit(0).cast("long")).alias("filled"))
        for c in expected
    ]
    return counted.select(F.inline(F.array(*entries)))


def read_features(spark: SparkSession, path: str, dataset: str) -> tuple[DataFrame, str]:
    """Feature-store table and the name of its target column."""
    target = fx.SNAPSHOT_TARGET if dataset == "snapshot" else fx.LOAN_TARGET
    return spark.read.parquet(path), target


def read_macro(spark: SparkSession, path: str) -> DataFrame:
    """Cached quarterly macro CSV."""
    return read_csv(spark, path, schemas.macro_schema())


def read_artifact(spark: SparkSession, path: str, schema: StructType, fmt: str = "json") -> DataFrame:
    """A stored result frame, or an empty frame of the same schema when it is absent."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
