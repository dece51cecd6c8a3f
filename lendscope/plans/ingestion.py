"""Raw file to enriched feature table (W1, W2), lazily up to the write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendscope import fixed_values as fx
from lendscope.operators import cleaning, features, macro
from lendscope.sources import readers, schemas, sinks


def clean_snapshot(raw: DataFrame, method: str = "approx") -> DataFrame:
    return cleaning.clean(cleaning.rename_id(raw), fx.SNAPSHOT_TARGET, "loan_id", method)


def snapshot_with_audit(raw: DataFrame, macro_table: DataFrame, method: str = "approx",
                        quarter: tuple[int, int] = fx.DEFAULT_MACRO_QUARTER) -> tuple[DataFrame, DataFrame]:
    """:func:`snapshot_table` and its audit row (C6), gathered while the distinct rows are written."""
    cleaned, audit = cleaning.clean_with_audit(cleaning.rename_id(raw), fx.SNAPSHOT_TARGET, "loan_id", method)
    return macro.enrich_with_macro(features.snapshot_features(cleaned), macro_table, quarter), audit


def snapshot_table(raw: DataFrame, macro_table: DataFrame, method: str = "approx",
                   quarter: tuple[int, int] = fx.DEFAULT_MACRO_QUARTER) -> DataFrame:
    """C9, C1, C3, C5, F17, J3."""
    return macro.enrich_with_macro(features.snapshot_features(clean_snapshot(raw, method)), macro_table, quarter)


def clean_loan_book(raw: DataFrame, method: str = "approx", keep_id: str | None = "loan_id") -> DataFrame:
    """S5, C7, C8, F2, C1, C2, C5. The id is kept, so that the star tables can be joined."""
    numeric, id_column = _numeric_loan_book(raw, keep_id)
    return cleaning.clean(numeric, fx.LOAN_TARGET, id_column, method)


def loan_book_with_audit(raw: DataFrame, macro_table: DataFrame, method: str = "approx",
                         keep_id: str | None = "loan_id") -> tuple[DataFrame, DataFrame]:
    """:func:`loan_book_table` and its audit row (C6) of the loans with a usable status."""
    numeric, id_column = _numeric_loan_book(raw, keep_id)
    cleaned, audit = cleaning.clean_with_audit(numeric, fx.LOAN_TARGET, id_column, method)
    return macro.enrich_with_macro(features.loan_book_features(cleaned), macro_table), audit


def _numeric_loan_book(raw: DataFrame, keep_id: str | None) -> tuple[DataFrame, str | None]:
    expected = [*fx.LOAN_COLUMNS, "funded_amnt", "total_acc"]
    if "id" in raw.columns and keep_id and keep_id not in raw.columns:
        raw = raw.withColumnRenamed("id", keep_id)
    has_id = bool(keep_id) and keep_id in raw.columns
    kept, _ = readers.column_contract(raw, [keep_id, *expected] if has_id else expected, fx.LOAN_STATUS)
    labelled = cleaning.encode_target(cleaning.keep_labelled(kept))
    return features.coerce_numbers(cleaning.percent_columns(labelled)), keep_id if has_id else None


def loan_book_table(raw: DataFrame, macro_table: DataFrame, method: str = "approx") -> DataFrame:
    """Cleaned loan book, F18, J1."""
    return macro.enrich_with_macro(features.loan_book_features(clean_loan_book(raw, method)), macro_table)


def ingest_snapshot(spark: SparkSession, path: str, macro_table: DataFrame, store: str) -> list[str]:
    raw = readers.read_csv(spark, path, schemas.snapshot_schema())
    return sinks.write_feature_store(snapshot_table(raw, macro_table), "snapshot", store)


def ingest_loan_book(spark: SparkSession, path: str, macro_table: DataFrame, store: str) -> list[str]:
    return sinks.write_feature_store(loan_book_table(readers.read_csv(spark, path), macro_table), "loan_book", store)
