"""Row-level expressions shared by the operators. All of them stay inside codegen.

Null rules follow the source semantics: comparisons with null give 0 in flags, clips keep
null, buckets of null are null. NaN is treated as null everywhere, because Spark orders
NaN above every number while the source treats it as missing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, functions as F

from lendscope import fixed_values as fx


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_number(c: Column | str) -> Column:
    """NaN becomes null; infinities stay. The (double) input is evaluated once."""
    return F.nanvl(as_column(c), F.lit(None).cast("double"))


def finite(c: Column | str) -> Column:
    """NaN and both infinities become null."""
    c = as_column(c)
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a number becomes null.

    ``try_cast`` also takes a type suffix ("1d", "2F"), which is text here.
    """
    text = as_column(c).cast("string")
    suffixed = text.rlike(r"[0-9.][dDfF]\s*$")
    return clean_number(F.when(~suffixed, text.try_cast("double")))


def percent_to_number(c: Column | str) -> Column:
    """"13.56%" to 13.56; plain numbers pass through; bad text becomes null."""
    return to_number(F.regexp_replace(as_column(c).cast("string"), "%", ""))


def at_least(c: Column | str, threshold: float = fx.DELINQUENCY_THRESHOLD) -> Column:
    """1 where the value reaches the threshold, else 0 (also for null)."""
    c = as_column(c)
    return F.coalesce(c >= threshold, F.lit(False)).cast("int")


def right_closed_bucket(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edge[i-1], edge[i]] that holds the value; outer ends are open."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    c = as_column(c)
    expr = F.when(c <= edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1], strict=True):
        expr = expr.when(c <= edge, label)
    return expr.when(c.isNotNull(), labels[-1])


def log1p_floor0(c: Column | str) -> Column:
    """log(1 + max(value, 0)); null stays null (``greatest`` would drop it)."""
    c = as_column(c).cast("double")
    return F.log1p(F.when(c < 0, F.lit(0.0)).otherwise(c))


def floor_at(c: Column | str, minimum: int) -> Column:
    c = as_column(c)
    return F.when(c < minimum, F.lit(minimum)).otherwise(c)


def row_sum(columns: Iterable[Column | str]) -> Column:
    """Sum over columns that skips nulls; 0 when all are null."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(as_column(c).cast("double"), F.lit(0.0))
    return total


def month_year_to_date(c: Column | str) -> Column:
    """"Dec-2011" to the first of that month; other text becomes null."""
    return F.try_to_date(as_column(c), fx.ISSUE_DATE_FORMAT)


def months_between_dates(latest: Column, earlier: Column) -> Column:
    """Whole calendar months between two dates, by year and month only."""
    years = F.year(latest) - F.year(earlier)
    return years * 12 + F.month(latest) - F.month(earlier)


def lookup(c: Column | str, table: Mapping[str, int]) -> Column:
    """Value of a small constant map; null for unknown keys."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), as_column(c))


def encode_employment(c: Column | str) -> Column:
    return F.coalesce(lookup(c, fx.EMPLOYMENT_YEARS), F.lit(fx.UNKNOWN_EMPLOYMENT))


def encode_grade(c: Column | str) -> Column:
    return lookup(c, fx.GRADE_ORDINALS)


def risk_grade(pd: Column | str) -> Column:
    """Grade of a default probability: [0, .05], (.05, .1], ... ; outside [0, 1] is null."""
    pd = as_column(pd)
    low, *inner, high = fx.RISK_GRADE_EDGES
    graded = right_closed_bucket(pd, inner, fx.RISK_GRADES)
    return F.when((pd >= low) & (pd <= high), graded)


def rate_metric(metric: str, value: Column | str) -> Column:
    """Rating word of a metric value; thresholds are exclusive."""
    value = as_column(value)
    *bands, (_, lowest) = fx.RATINGS[metric]
    expr = None
    for limit, word in bands:
        expr = F.when(value > limit, word) if expr is None else expr.when(value > limit, word)
    return expr.otherwise(lowest)


def safe_ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """Division that gives ``default`` where the denominator is 0."""
    ratio = F.when(denominator != 0, numerator.cast("double") / denominator.cast("double"))
    return ratio if default is None else F.coalesce(ratio, F.lit(default))


def md5_key(c: Column | str) -> Column:
    """Repeatable pseudo-random order key of an id, equal in every engine."""
    return F.md5(as_column(c).cast("string"))


def hash52(c: Column | str) -> Column:
    """First 52 bits of :func:`md5_key` as a double, so ranks over it are exact."""
    return F.conv(F.substring(md5_key(c), 1, 13), 16, 10).cast("double")
