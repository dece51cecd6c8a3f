"""Splits, samples, scaling and class weights.

Random choices are made by a hash of the row id, so they do not depend on partitioning and a
lost task repeats the same choice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lendscope import fixed_values as fx
from lendscope.functions import hash52, md5_key
from lendscope.operators.cleaning import _c
from lendscope.operators.quantiles import exact_quantiles

SORTED_ROWS = 1_000_000


def stratified_split(
    df: DataFrame,
    target: str,
    id_column: str = "loan_id",
    test_share: float = fx.TEST_SHARE,
    validation_share: float = fx.VALIDATION_SHARE_OF_REST,
    output: str = "split",
) -> DataFrame:
    """Train / validation / test label with exact shares in each class.

    The cut hashes of each class are order statistics, so no class is sorted in one place and
    the split itself is a row expression.
    """
    key = hash52(_c(id_column))

    def tested(n: int) -> int:
        return round(test_share * n)

    def held_out(n: int) -> int:
        return tested(n) + round(validation_share * (n - tested(n)))

    both = test_share + validation_share * (1 - test_share)
    wanted = {}
    for label in (0, 1):
        own = F.when(_c(target) == label, key)
        wanted[f"test{label}"] = (own, test_share, lambda n: tested(n) - 1)
        wanted[f"held{label}"] = (own, both, lambda n: held_out(n) - 1)
    sizes: dict[str, int] = {}
    cuts = exact_quantiles(df, wanted, counts=sizes)
    part = F.lit("train")
    for label in (0, 1):
        n, own = sizes[f"test{label}"], _c(target) == label
        if held_out(n) > 0:
            part = F.when(own & (key <= cuts[f"held{label}"]), "validation").otherwise(part)
        if tested(n) > 0:
            part = F.when(own & (key <= cuts[f"test{label}"]), "test").otherwise(part)
    return df.withColumn(output, part)


def hashed_split(
    df: DataFrame,
    id_column: str = "loan_id",
    test_share: float = fx.TEST_SHARE,
    validation_share: float = fx.VALIDATION_SHARE_OF_REST,
    output: str = "split",
) -> DataFrame:
    """Split by hash range alone: no job and no shuffle, shares hold approximately."""
    u = hash52(_c(id_column)) / float(2**52)
    both = test_share + validation_share * (1 - test_share)
    return df.withColumn(output, F.when(u < test_share, "test").when(u < both, "validation").otherwise("train"))


def split_audit(df: DataFrame, target: str, split: str = "split") -> DataFrame:
    """Size and default rate per split, and overall."""
    return df.rollup(split).agg(F.count(F.lit(1)).alias("rows"), F.avg(_c(target)).alias("default_rate")).select(
        F.coalesce(F.col(split), F.lit("overall")).alias("split"), "rows", "default_rate"
    )


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column; constant columns keep deviation 1."""

    means: Mapping[str, float]
    deviations: Mapping[str, float]

    def scaled(self, column: str) -> Column:
        return (_c(column).cast("double") - F.lit(self.means[column])) / F.lit(self.deviations[column])


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    aggregates = []
    for i, c in enumerate(columns):
        value = _c(c).cast("double")
        aggregates += [F.avg(value).alias(f"m{i}"), F.stddev_pop(value).alias(f"s{i}")]
    row = df.agg(*aggregates).first()
    means = {c: row[f"m{i}"] if row[f"m{i}"] is not None else 0.0 for i, c in enumerate(columns)}
    spread = {c: row[f"s{i}"] or 1.0 for i, c in enumerate(columns)}
    tiny = {c: 1.0 if s < 1e-12 * max(1.0, abs(means[c])) else s for c, s in spread.items()}
    return Scaler(means, tiny)


def scale(df: DataFrame, scaler: Scaler) -> DataFrame:
    return df.withColumns({c: scaler.scaled(c) for c in scaler.means})


def class_weights(df: DataFrame, target: str) -> dict[int, float]:
    """Balanced weights n / (classes * n_class)."""
    sizes = {r[0]: r[1] for r in df.filter(_c(target).isNotNull()).groupBy(_c(target)).count().collect()}
    total = sum(sizes.values())
    return {label: total / (len(sizes) * n) for label, n in sizes.items()}


def add_class_weight(df: DataFrame, target: str, output: str = "class_weight") -> DataFrame:
    weight = F.lit(None).cast("double")
    for label, w in class_weights(df, target).items():
        weight = F.when(_c(target) == label, F.lit(w)).otherwise(weight)
    return df.withColumn(output, weight)


def smallest_rows(df: DataFrame, value: Column, order: Sequence[Column], n: int, sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """First ``n`` rows by ``order``, whose leading term is ``value`` or orders rows as it does.

    Rows without a value come first and NaN comes last, as in any ascending Spark order. Large
    inputs are filtered at the n-th smallest value first. A plain top-n would ship n rows from
    each of many partitions to one task.
    """
    facts = df.agg(F.count(F.lit(1)), F.count_if(value.isNull()), F.count_if(F.isnan(value.cast("double")))).first()
    total, missing, undefined = (int(x) for x in facts)
    if total <= n:
        return df
    if total > sorted_rows:
        numbers, position = total - missing - undefined, n - missing - 1
        if position < 0:
            df = df.filter(value.isNull())
        elif position < numbers:
            cut = exact_quantiles(df, {"cut": (value, position / numbers, lambda _: position)})["cut"]
            df = df.filter(value.isNull() | (value <= cut))
    return df.orderBy(*order).limit(n)


def hash_sample(df: DataFrame, n: int, id_column: str = "loan_id", sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """Repeatable random sample of exactly ``n`` rows (all rows if there are fewer)."""
    return smallest_rows(df, hash52(_c(id_column)), [md5_key(_c(id_column)), _c(id_column)], n, sorted_rows)


def head_rows(df: DataFrame, n: int, key: str = "loan_id", sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """First ``n`` rows by a numeric key (Spark rows have no order of their own)."""
    return smallest_rows(df, _c(key).cast("double"), [_c(key)], n, sorted_rows)
