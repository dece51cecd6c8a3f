"""Column expressions; each takes and returns Spark Columns."""

from lendscope.functions.scalar import (  # noqa: F401
    at_least, clean_number, encode_employment, encode_grade, finite, floor_at, hash52,
    log1p_floor0, lookup, md5_key, month_year_to_date, months_between_dates,
    percent_to_number, rate_metric, right_closed_bucket, risk_grade, row_sum, safe_ratio,
    to_number,
)
