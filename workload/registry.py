"""Registration of queries and expansion of the views their SQL uses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.views import with_views

ENTRIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, sf_dir)``; views named in the SQL are added as WITH clauses."""

    def register(f):
        if name in ENTRIES:
            raise ValueError(f"duplicate query {name}")
        ENTRIES[name] = (f, with_views(sql) if sql else None)
        return f

    return register
