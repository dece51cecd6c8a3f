"""Row filters, duplicate removal, imputation and audits."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, NumericType, ShortType

from lendscope import fixed_values as fx
from lendscope.functions import finite, percent_to_number
from lendscope.operators.quantiles import exact_quantiles
from lendscope.operators.shared_storage import cut_lineage

_WHOLE = (ByteType, ShortType, IntegerType, LongType)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skipped = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in skipped]


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(_c(target).isNotNull())


def drop_duplicate_rows(df: DataFrame, id_column: str | None = None) -> DataFrame:
    """Distinct rows; with an id column, distinct apart from the id, keeping the smallest id.

    Both forms add up on the map side, so a row copied many times costs one row per task.
    """
    if id_column is None or id_column not in df.columns:
        return df.distinct()
    rest = [c for c in df.columns if c != id_column]
    kept = df.groupBy(*[_c(c) for c in rest]).agg(F.min(_c(id_column)).alias(id_column))
    return kept.select(*[_c(c) for c in df.columns])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_count) of the numeric columns, counted in one pass."""
    columns = numeric_columns(df) if columns is None else list(columns)
    counted = df.agg(*[F.count_if(_c(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], [_c(c) for c in columns], "column", "null_count")


def gap_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at least one null, found in one pass."""
    if not columns:
        return []
    gaps = df.agg(*[F.count_if(_c(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if gaps[c]]


def median_values(df: DataFrame, columns: Sequence[str], method: str = "exact", relative_error: float = 0.01) -> dict[str, float]:
    """Median per column, all columns in the same pass; all-null columns are left out."""
    if not columns:
        return {}
    if method == "exact":
        found = exact_quantiles(df, {c: (_c(c), 0.5) for c in columns})
    elif method == "approx":
        accuracy = max(1, round(1 / relative_error))
        exprs = [F.percentile_approx(_c(c).cast("double"), 0.5, accuracy).alias(c) for c in columns]
        found = df.agg(*exprs).first().asDict()
    else:
        raise ValueError(f"unknown median method: {method}")
    return {c: v for c, v in found.items() if v is not None}


def fill_values(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Replace nulls by constants. Whole-number columns keep their type and truncate the value."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    filled = {}
    for name, value in values.items():
        kind = kinds[name]
        constant = F.lit(int(value)) if isinstance(kind, _WHOLE) else F.lit(float(value))
        filled[name] = F.coalesce(_c(name), constant.cast(kind))
    return df.withColumns(filled) if filled else df


def impute_medians(df: DataFrame, target: str, method: str = "approx", relative_error: float = 0.01) -> DataFrame:
    """Median imputation of the numeric non-target columns with nulls, the id and decimals included."""
    columns = numeric_columns(df, [target])
    return fill_values(df, median_values(df, gap_columns(df, columns), method, relative_error))


def clean(df: DataFrame, target: str, id_column: str | None = None, method: str = "approx") -> DataFrame:
    """C1, then C2 or C3, then C5.

    The distinct rows are written once to the shared folder: the medians and whatever comes
    next read that table instead of shuffling for the duplicates again.
    """
    kept = drop_duplicate_rows(drop_null_target(df, target), id_column)
    return impute_medians(cut_lineage(kept), target, method)


def clean_with_audit(df: DataFrame, target: str, id_column: str | None = None, method: str = "approx") -> tuple[DataFrame, DataFrame]:
    """The frame of :func:`clean` and, from the same pass over ``df``, the audit row of :func:`row_flow`.

    Each distinct row is written with the number of its copies, and all rows without a target as one more row, so the
    audit is a sum over two columns of the written table: ``df`` is neither read nor grouped again, and a repeated
    task cannot count a row twice.
    """
    copies = "_copies"
    while copies in (c.lower() for c in df.columns):
        copies = f"_{copies}"
    labelled = _c(target).isNotNull()
    rest = [c for c in df.columns if c != id_column]
    least = [F.min(_c(id_column)).alias(id_column)] if id_column in df.columns else []
    groups = df.groupBy(*[F.when(labelled, _c(c)).alias(c) for c in rest]).agg(F.count(F.lit(1)).alias(copies), *least)
    written = cut_lineage(groups)
    kept = written.filter(labelled).select(*[_c(c) for c in df.columns])
    return impute_medians(kept, target, method), _flow(written, target, copies)


def row_flow(df: DataFrame, target: str, id_column: str | None = None) -> DataFrame:
    """One audit row: rows before, after the target filter, after duplicate removal, % kept.

    One aggregation over per-row-content counts instead of a count per step.
    """
    rest = [c for c in df.columns if c != id_column]
    groups = df.groupBy(*[_c(c) for c in rest]).agg(F.count(F.lit(1)).alias("_copies"))
    return _flow(groups, target, "_copies")


def _flow(groups: DataFrame, target: str, copies: str) -> DataFrame:
    labelled = _c(target).isNotNull()
    flow = groups.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("initial_rows"),
        F.coalesce(F.sum(F.when(labelled, F.col(copies))), F.lit(0)).alias("labelled_rows"),
        F.count_if(labelled).alias("final_rows"),
    )
    return flow.select(
        "initial_rows", "labelled_rows",
        (F.col("initial_rows") - F.col("labelled_rows")).alias("dropped_null_target"),
        (F.col("labelled_rows") - F.col("final_rows")).alias("dropped_duplicates"),
        "final_rows",
        (F.col("final_rows") * 100.0 / F.greatest("initial_rows", F.lit(1))).alias("pct_retained"),
    )


def keep_labelled(df: DataFrame, column: str = fx.LOAN_STATUS) -> DataFrame:
    return df.filter(_c(column).isin(*fx.DEFAULT_STATUSES, *fx.PAID_STATUSES))


def encode_target(df: DataFrame, column: str = fx.LOAN_STATUS, output: str = fx.LOAN_TARGET) -> DataFrame:
    return df.withColumn(output, F.when(_c(column).isin(*fx.DEFAULT_STATUSES), 1).otherwise(0))


def percent_columns(df: DataFrame, columns: Sequence[str] = fx.LOAN_PERCENT_COLUMNS) -> DataFrame:
    return df.withColumns({c: percent_to_number(_c(c)) for c in columns if c in df.columns})


def rename_id(df: DataFrame, old: str = "row_id", new: str = "loan_id") -> DataFrame:
    return df.withColumnRenamed(old, new)


def feature_columns(df: DataFrame, target: str, deny: Iterable[str] = fx.NON_FEATURES) -> list[str]:
    return numeric_columns(df, {target, *deny})


def feature_matrix(df: DataFrame, target: str, id_column: str | None = None, fill: Mapping[str, float] | None = None) -> DataFrame:
    """Numeric features as doubles, gaps and infinities filled by exact medians, plus the label.

    ``fill`` takes medians fitted elsewhere, for example on a training split only.
    """
    names = [c for c in feature_columns(df, target) if c != id_column]
    if fill is None:
        usable = df.select(*[finite(_c(c).cast("double")).alias(c) for c in names])
        fill = median_values(usable, gap_columns(usable, names))
    kept = [_c(id_column)] if id_column else []
    filled = [
        F.coalesce(finite(_c(c).cast("double")), F.lit(fill.get(c)).cast("double")).alias(c) for c in names
    ]
    return df.select(*kept, *filled, _c(target).cast("int").alias(target))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    share = F.avg(_c(target)) * 100
    return df.agg(share.alias("pct_default"), (F.lit(100.0) - share).alias("pct_non_default"))


def healthy_only(df: DataFrame, target: str) -> DataFrame:
    return df.filter(_c(target) == 0)
