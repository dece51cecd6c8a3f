"""Minority oversampling by interpolation between nearest neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lendscope import fixed_values as fx
from lendscope.functions import hash52
from lendscope.operators.cleaning import _c
from lendscope.operators.neighbours import nearest_neighbours, projected_neighbours
from lendscope.operators.quantiles import exact_quantiles
from lendscope.operators.shared_storage import join_large

BLOCK = 10_000
SEARCHES = {"projected": projected_neighbours, "exact": nearest_neighbours}


def _uniform(*parts: Column) -> Column:
    """Repeatable number in [0, 1) from a hash of the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / float(1 << 53)


def synthetic_minority(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    id_column: str = "loan_id",
    k: int = fx.SMOTE_NEIGHBOURS,
    seed: int = fx.SEED,
    method: str = "projected",
    **options,
) -> DataFrame:
    """Synthetic minority rows that bring both classes to the same size.

    ``method`` "projected" searches neighbours in random-projection trees, in linear time; "exact" compares
    all leaves that may hold a neighbour. ``options`` go to the search. Ids may be of any type.

    Every minority row is the base of equally many synthetic rows (the remainder goes to the
    rows with the lowest id hash). Each lies between its base and one of the ``k`` nearest
    minority rows. Columns: the features, target, base_key and neighbour (vectors' origin).
    """
    features = list(features)
    sizes = {r[0]: r[1] for r in df.filter(_c(target).isin(0, 1)).groupBy(_c(target)).count().collect()}
    if len(sizes) < 2:
        raise ValueError("two classes are needed")
    minority = min(sizes, key=lambda label: (sizes[label], -label))
    few, many = sizes[minority], max(sizes.values())
    if few <= k:
        raise ValueError(f"at least {k + 1} minority rows are needed, found {few}")
    base, rest = divmod(many - few, few)
    rows = df.filter(_c(target) == minority)
    key = hash52(_c(id_column))
    chosen = F.lit(0)
    if rest:
        cut = exact_quantiles(rows, {"cut": (key, rest / few, lambda _: rest - 1)})["cut"]
        chosen = (key <= cut).cast("int")
    known = dict(rows.dtypes)[id_column]
    number = _c(id_column) if known in ("bigint", "int", "smallint", "tinyint") else F.xxhash64(_c(id_column))
    vectors = [_c(c).cast("double").alias(c) for c in features]
    distinct = rows.select(number.cast("long").alias("key"), chosen.alias("_more"), *vectors).groupBy(*[_c(c) for c in features]).agg(
        F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.sum("_more").alias("_more")
    )
    counted = distinct.withColumn("_n", F.col("copies") * base + F.col("_more"))
    if method not in SEARCHES:
        raise ValueError(f"unknown method: {method}")
    found = SEARCHES[method](counted.withColumn("wanted", F.col("_n") > 0), features, k, **options)
    blocks = join_large(counted.filter("_n > 0"), found, "key").withColumn("_block", F.explode(F.expr(f"sequence(0L, (_n - 1) div {BLOCK}L)")))
    spread = blocks.repartition(F.col("key"), F.col("_block"))
    numbered = spread.withColumn(
        "_copy", F.explode(F.expr(f"sequence(_block * {BLOCK}L, least(_n, (_block + 1) * {BLOCK}L) - 1)"))
    )
    pick = F.floor(_uniform(F.col("key"), F.col("_copy"), F.lit(seed)) * F.size("neighbours")).cast("int")
    picked = numbered.withColumn("neighbour", F.get("neighbours", pick)).withColumn(
        "_step", _uniform(F.col("key"), F.col("_copy"), F.lit(seed + 1))
    )
    return picked.select(
        *[(_c(c) + F.col("_step") * (F.get("neighbour", F.lit(i)) - _c(c))).alias(c) for i, c in enumerate(features)],
        F.lit(minority).cast("int").alias(target), F.col("key").alias("base_key"), "neighbour",
    )


def balance_classes(df: DataFrame, features: Sequence[str], target: str, id_column: str = "loan_id", **options) -> DataFrame:
    """The given rows and the synthetic minority rows (features and target only)."""
    columns = [*[_c(c).cast("double").alias(c) for c in features], _c(target).cast("int").alias(target)]
    synthetic = synthetic_minority(df, features, target, id_column, **options)
    return df.select(*columns).unionByName(synthetic.select(*columns))
