"""Compare registered queries with their SQL: ``python -m workload.check [name-prefix ...]``.

Reads the scale folder from SF_DIR. Exact comparison of names, types, row counts and values.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from workload import load
from workload.views import TABLES


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("lendscope")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _rows(table) -> list:
    names = sorted(table.column_names)
    return sorted(map(repr, zip(*[table.column(n).to_pylist() for n in names], strict=True)))


def _types(table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def compare(spark_table, oracle_table) -> str:
    """Empty text when both are equal, else what differs."""
    if sorted(spark_table.column_names) != sorted(oracle_table.column_names):
        return f"columns {spark_table.column_names} != {oracle_table.column_names}"
    ours, theirs = _types(spark_table), _types(oracle_table)
    if ours != theirs:
        return "types " + str({n: (ours[n], theirs[n]) for n in ours if ours[n] != theirs[n]})
    if spark_table.num_rows != oracle_table.num_rows:
        return f"rows {spark_table.num_rows} != {oracle_table.num_rows}"
    a, b = _rows(spark_table), _rows(oracle_table)
    differing = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    return f"{len(differing)} values differ, first {differing[0]}" if differing else ""


def main(prefixes: list[str]) -> int:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = session(), oracle_connection(sf_dir)
    failed = 0
    for name, (build, sql) in sorted(load().items()):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            got = build(spark, sf_dir).toArrow()
            took = time.time() - start
            problem = compare(got, con.sql(sql).to_arrow_table()) if sql else ("" if got.num_rows else "no rows")
        except Exception as e:  # report and go on with the next query
            took, problem = time.time() - start, f"{type(e).__name__}: {str(e)[:600]}"
            got = None
        failed += bool(problem)
        rows = "" if got is None else got.num_rows
        print(f"{'FAIL' if problem else 'ok  '} {name} {rows} rows {took:.2f}s {'sql' if sql else 'rows'} {problem}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
