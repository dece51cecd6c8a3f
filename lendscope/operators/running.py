"""Running sums and row numbers that stay parallel within one large group.

A window without enough partitions sorts a whole group in one task. Here groups above a row
limit are cut into value ranges at approximate quantiles, or for row numbers into sorted ranges of
whole rows (any cuts give the same result, they only balance the work). Totals per range are small; their running sums are added to a window
that runs inside each range. Groups below the limit use the ordinary window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from lendscope.operators.shared_storage import cut_lineage

GROUP_ROWS = 1_000_000
MOST_RANGES = 10_000
MOST_BROADCAST = 100_000


def range_count(rows: int, group_rows: int = GROUP_ROWS) -> int:
    """Ranges to cut ``rows`` into, so that each holds about half the group limit."""
    return max(16, min(MOST_RANGES, 2 * math.ceil(rows / group_rows)))


def split_points(df: DataFrame, value: str, ranges: int) -> tuple[list[float], set[float]]:
    """Cut points that balance rows over value ranges, and the values hot enough to fill one."""
    steps = [i / ranges for i in range(1, ranges)]
    row = df.agg(F.percentile_approx(F.col(value), steps, 10 * ranges)).first()
    points = row[0] or []
    hot = {a for a, b in zip(points, points[1:]) if a == b}
    return sorted(set(points)), hot


def range_number(df: DataFrame, value: str, points: Sequence[float], output: str) -> DataFrame:
    """Number of the value range of each row; ranges are left-closed and in value order."""
    if not points:
        return df.withColumn(output, F.lit(0))
    splits = [-math.inf, *points, math.inf]
    cut = Bucketizer(splits=splits, inputCol=value, outputCol=output, handleInvalid="keep")
    return cut.transform(df).withColumn(output, F.col(output).cast("int"))


def running_counts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    measures: dict[str, Column],
    previous: bool = False,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Per distinct value of each group: sums, inclusive running sums and group totals.

    ``measures`` maps a name m to a summed expression; the result has columns m, cum_m and
    total_m, one row per (keys, value); ``previous`` adds prev_m, the sum at the next lower
    value. Rows are first added up per distinct value, on the map side, so ties cost nothing
    downstream.
    """
    keys = list(keys)
    base = df.select(*keys, F.col(value), *[e.alias(m) for m, e in measures.items()]).filter(F.col(value).isNotNull())
    sums = base.groupBy(*keys, value).agg(*[F.sum(m).alias(m) for m in measures])
    largest = base.groupBy(*keys).agg(F.approx_count_distinct(value).alias("n")).agg(F.max("n")).first()[0]
    if (largest or 0) <= group_rows:
        return _plain_running(sums, keys, value, list(measures), previous)
    points, _ = split_points(base, value, range_count(largest, group_rows))
    return ranged_running(sums, keys, value, list(measures), points, previous)


def _plain_running(sums: DataFrame, keys: list[str], value: str, measures: list[str], previous: bool) -> DataFrame:
    group = Window.partitionBy(*keys)
    ordered = group.orderBy(value)
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    added = {f"cum_{m}": F.sum(m).over(upto) for m in measures}
    added |= {f"total_{m}": F.sum(m).over(group) for m in measures}
    if previous:
        added |= {f"prev_{m}": F.lag(m).over(ordered) for m in measures}
    return sums.withColumns(added)


def ranged_running(
    sums: DataFrame, keys: list[str], value: str, measures: list[str], points: Sequence[float], previous: bool = False
) -> DataFrame:
    """:func:`running_counts` after the cut: at most ``len(points) + 1`` range totals per group."""
    ranged = range_number(sums, value, points, "_range")
    totals = ranged.groupBy(*keys, "_range").agg(
        *[F.sum(m).alias(f"_{m}") for m in measures],
        *[F.max_by(m, value).alias(f"_last_{m}") for m in measures],
    )
    group = Window.partitionBy(*keys)
    ordered = group.orderBy("_range")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_range",
        *[F.coalesce(F.sum(f"_{m}").over(before), F.lit(0)).alias(f"_before_{m}") for m in measures],
        *[F.sum(f"_{m}").over(group).alias(f"total_{m}") for m in measures],
        *[F.lag(f"_last_{m}").over(ordered).alias(f"_edge_{m}") for m in measures],
    )
    piece = Window.partitionBy(*keys, "_range").orderBy(value)
    upto = piece.rowsBetween(Window.unboundedPreceding, 0)
    local = {f"_local_{m}": F.sum(m).over(upto) for m in measures}
    local |= {f"_lag_{m}": F.lag(m).over(piece) for m in measures}
    joined = ranged.withColumns(local).join(offsets, [*keys, "_range"])
    return joined.select(
        *keys, value, *measures,
        *[(F.col(f"_local_{m}") + F.col(f"_before_{m}")).alias(f"cum_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
        *([F.coalesce(f"_lag_{m}", f"_edge_{m}").alias(f"prev_{m}") for m in measures] if previous else []),
    )


def number_rows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    output: str = "row_no",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """1-based row number per key in the given order, with large keys cut into ranges.

    The keys above the limit are few (rows / limit), and only their rows are dealt out by range. A null key is a key like others.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    above = F.col("_n") > group_rows
    keys, rows = sizes.agg(F.count_if(above), F.sum(F.when(above, F.col("_n")))).first()
    plain = F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long")
    if not keys:
        return df.withColumn(output, plain)
    large = sizes.filter(above).select(F.col(key).alias("_large_key"), F.lit(True).alias("_large"))
    large = F.broadcast(large) if keys <= MOST_BROADCAST else large
    marked = df.join(large, F.col(key).eqNullSafe(F.col("_large_key")), "left").drop("_large_key")
    small = marked.filter("_large IS NULL").drop("_large").withColumn(output, plain)
    placed = dealt_by_range(marked.filter("_large").drop("_large"), [key, *order], range_count(rows, group_rows))
    # Within a range a key's rows have consecutive places; the rows of the ranges before come first.
    pieces = placed.groupBy(key, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_first")
    offsets = pieces.select(F.col(key).alias("_piece_key"), F.col("_range").alias("_piece"), shift.alias("_shift"))
    same = F.col(key).eqNullSafe(F.col("_piece_key")) & (F.col("_range") == F.col("_piece"))
    offsets = F.broadcast(offsets) if keys <= MOST_BROADCAST else offsets  # a row per range, and one more per key
    numbered = placed.join(offsets, same).select(*df.columns, (F.col("_at") + F.col("_shift")).alias(output))
    return numbered.unionByName(small)


def dealt_by_range(df: DataFrame, order: Sequence[str], ranges: int) -> DataFrame:
    """The rows as a table in ``ranges`` sorted ranges of about equal size, with _range and place _at, both ascending in ``order``.

    Rows that tie in all of ``order`` go by a hash of the whole row, so one value, of whatever type, may be on every
    row: only rows that are equal altogether stay in one range.
    """
    tied = df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    ranged = tied.repartitionByRange(ranges, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id()))
    return placed.withColumn("_range", F.shiftright("_at", 33))  # the id holds the partition's number above 33 bits
