"""Quarterly macro series: alignment, resampling and enrichment of loans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lendscope import fixed_values as fx


def align_series(observations: DataFrame, series: Mapping[str, str] = fx.MACRO_SERIES) -> DataFrame:
    """Long (obs_date, series_id, value) to one row per date and one column per series."""
    picked = [F.avg(F.when(F.col("series_id") == s, F.col("value"))).alias(s) for s in series]
    return observations.groupBy("obs_date").agg(*picked)


def quarter_means(aligned: DataFrame, series: Mapping[str, str] = fx.MACRO_SERIES) -> DataFrame:
    """Null-skipping mean per quarter; quarters without data inside the range are null rows.

    The calendar comes from the date range alone, so its size is the number of quarters.
    """
    quarter = F.trunc("obs_date", "quarter").alias("quarter_start")
    means = aligned.groupBy(quarter).agg(*[F.avg(s).alias(s) for s in series])
    span = aligned.agg(
        F.trunc(F.min("obs_date"), "quarter").alias("first"), F.trunc(F.max("obs_date"), "quarter").alias("last")
    ).filter(F.col("first").isNotNull())
    calendar = span.select(F.explode(F.expr("sequence(first, last, interval 3 months)")).alias("quarter_start"))
    return calendar.join(means, "quarter_start", "left")


def name_measures(quarterly: DataFrame, series: Mapping[str, str] = fx.MACRO_SERIES) -> DataFrame:
    """Year and quarter columns, series ids renamed to measures, the date index dropped."""
    return quarterly.select(
        F.year("quarter_start").alias("year"), F.quarter("quarter_start").alias("quarter"),
        *[F.col(s).alias(measure) for s, measure in series.items()],
    )


def quarterly_macro(observations: DataFrame) -> DataFrame:
    """Irregular observations to the quarterly macro table."""
    return name_measures(quarter_means(align_series(observations)))


MOST_QUARTERS = 10_000


def join_macro(loans: DataFrame, macro: DataFrame, most_quarters: int = MOST_QUARTERS) -> DataFrame:
    """Left join on the issue quarter.

    The macro side is broadcast after its rows are counted: a table of quarters has a few hundred.
    Left to itself the planner would shuffle all loans by quarter before it knows that size. More
    than ``most_quarters`` rows are no macro table and raise.
    """
    if (rows := macro.count()) > most_quarters:
        raise ValueError(f"{rows} rows of quarterly data; at most {most_quarters} are joined")
    on = (F.col("issue_year") == F.col("year")) & (F.col("issue_quarter") == F.col("quarter"))
    return loans.join(F.broadcast(macro), on, "left").drop("year", "quarter")


def macro_match_rate(enriched: DataFrame, measure: str = "unemployment_rate") -> DataFrame:
    return enriched.agg(
        F.count(measure).alias("matched"),
        F.count(F.lit(1)).alias("total"),
        (F.count(measure) * 100.0 / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("pct_matched"),
    )


def constant_macro(loans: DataFrame, macro: DataFrame, quarter: tuple[int, int] = fx.DEFAULT_MACRO_QUARTER) -> DataFrame:
    """Every row gets the measures of one quarter; no columns are added when it is absent."""
    year, number = quarter
    row = macro.filter((F.col("year") == year) & (F.col("quarter") == number)).first()
    if row is None:
        return loans
    measures = {m: F.lit(row[m]).cast("double") for m in fx.MACRO_MEASURES if m in macro.columns}
    return loans.withColumns(measures)


def enrich_with_macro(loans: DataFrame, macro: DataFrame, quarter: tuple[int, int] = fx.DEFAULT_MACRO_QUARTER) -> DataFrame:
    if {"issue_year", "issue_quarter"} <= set(loans.columns):
        return join_macro(loans, macro)
    return constant_macro(loans, macro, quarter)
