"""Equal-width histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendscope.operators.quantiles import exact_quantiles


def _bin_index(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin of x with half-open bins and a closed last one, checked against the bin edges."""
    width = (high - low) / bins
    guess = F.least(F.floor((x - low) / (high - low) * bins), F.lit(bins - 1))
    down = F.when(x < low + guess * width, guess - 1).otherwise(guess)
    up = (down < bins - 1) & (x >= low + (down + 1) * width)
    return F.when(up, down + 1).otherwise(down).cast("int")


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None, own_range: bool = False, density: bool = False) -> DataFrame:
    """Rows per bin (empty bins left out), optionally per group.

    ``own_range`` gives each group its own bin range. The groups have to be few: their ranges
    are fetched as plain numbers, which keeps the binning a row expression.
    """
    rows = df.filter(F.col(column).isNotNull())
    grouping = [by] if by else []
    ranges = rows.groupBy(*(grouping if own_range else [])).agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.count(F.lit(1)).alias("n")
    ).collect()
    low = high = F.lit(None).cast("double")
    for r in ranges:
        if r["low"] is None:
            continue
        ends = (r["low"], r["high"]) if r["high"] > r["low"] else (r["low"] - 0.5, r["high"] + 0.5)
        mine = F.col(by) == r[by] if own_range else F.lit(True)
        low = F.when(mine, F.lit(float(ends[0]))).otherwise(low)
        high = F.when(mine, F.lit(float(ends[1]))).otherwise(high)
    x = F.col(column).cast("double")
    binned = rows.select(*grouping, _bin_index(x, low, high, bins).alias("bin"), low.alias("_low"), high.alias("_high"))
    counted = binned.groupBy(*grouping, "bin", "_low", "_high").agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("_high") - F.col("_low")) / bins
    out = counted.select(
        *grouping, "bin", (F.col("_low") + F.col("bin") * width).alias("bin_start"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("bin_end"), F.col("n"),
    )
    if not density:
        return out
    sizes = rows.groupBy(*grouping).agg(F.count(F.lit(1)).alias("_all")).collect()
    total = F.lit(None).cast("double")
    for r in sizes:
        mine = F.col(by) == r[by] if by else F.lit(True)
        total = F.when(mine, F.lit(float(r["_all"]))).otherwise(total)
    return out.withColumn("density", F.col("n") / (total * (F.col("bin_end") - F.col("bin_start"))))


def centre(df: DataFrame, column: str) -> DataFrame:
    """Mean and exact median of a column as one row."""
    median = exact_quantiles(df, {"median": (F.col(column), 0.5)})["median"]
    return df.agg(F.avg(column).alias("mean")).withColumn("median", F.lit(median).cast("double"))
