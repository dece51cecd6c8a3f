"""Expected loss and portfolio aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendscope import fixed_values as fx
from lendscope.functions import risk_grade, safe_ratio
from lendscope.operators.quantiles import exact_quantiles


def expected_loss(df: DataFrame, pd: str = "pd_predicted", lgd: float = fx.LGD, ead: float | str = fx.FIXED_EAD) -> DataFrame:
    """Loan-level EL = PD x LGD x EAD; the exposure is an amount or a column name."""
    exposure: Column = F.col(ead).cast("double") if isinstance(ead, str) else F.lit(float(ead))
    return df.withColumn("lgd", F.lit(float(lgd))).withColumn("ead", exposure).withColumn(
        "expected_loss", F.col(pd) * F.col("lgd") * F.col("ead")
    )


def grade_loans(df: DataFrame, pd: str = "pd_predicted") -> DataFrame:
    return df.withColumn("risk_grade", risk_grade(pd))


def portfolio_summary(df: DataFrame, pd: str = "pd_predicted", lgd: float = fx.LGD, fixed_ead: float = fx.FIXED_EAD) -> DataFrame:
    """One row over loan-level expected losses, with an exact median PD."""
    median = exact_quantiles(df, {"median": (F.col(pd), 0.5)})["median"]
    return df.agg(
        F.count(F.lit(1)).alias("total_loans"),
        F.sum("ead").alias("total_ead"),
        F.sum("expected_loss").alias("total_expected_loss"),
        (safe_ratio(F.sum("expected_loss"), F.sum("ead")) * 100).alias("el_as_pct_of_ead"),
        F.avg(pd).alias("average_pd"),
    ).withColumns({
        "median_pd": F.lit(median).cast("double"),
        "lgd_assumption": F.lit(float(lgd)),
        "fixed_ead_assumption": F.lit(float(fixed_ead)),
    })


def segment_summary(df: DataFrame, pd: str = "pd_predicted") -> DataFrame:
    """Per risk grade; ungraded loans form no segment but count in the portfolio share."""
    by_grade = df.groupBy("risk_grade").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count(pd).alias("loan_count"),
        F.avg(pd).alias("avg_pd"),
        F.sum("ead").alias("total_ead"),
        F.sum("expected_loss").alias("total_el"),
    )
    everything = Window.partitionBy(F.lit(0))
    shared = by_grade.withColumn("_all", F.sum("_rows").over(everything)).filter(F.col("risk_grade").isNotNull())
    return shared.select(
        "risk_grade", "loan_count", "avg_pd", "total_ead", "total_el",
        (F.col("loan_count") * 100.0 / F.col("_all")).alias("pct_of_portfolio"),
        (safe_ratio(F.col("total_el"), F.col("total_ead")) * 100).alias("el_pct_of_ead"),
    )


def segment_share(segments: DataFrame) -> DataFrame:
    """Share of loans per grade, over the graded loans."""
    everything = Window.partitionBy(F.lit(0))
    return segments.select("risk_grade", "loan_count", (F.col("loan_count") * 100.0 / F.sum("loan_count").over(everything)).alias("share_pct"))


def cumulative_loss(segments: DataFrame) -> DataFrame:
    """Running expected loss from the safest grade on (at most one row per grade)."""
    upto = Window.partitionBy(F.lit(0)).orderBy("risk_grade").rowsBetween(Window.unboundedPreceding, 0)
    return segments.select("risk_grade", "total_el", F.sum("total_el").over(upto).alias("cumulative_el"))
