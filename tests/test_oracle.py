"""Every registered query runs on the small tables; those with SQL agree with it."""

import pytest

import __spark_entry__ as entry_point
from lendscope import fixed_values as fx
from workload.check import compare, oracle_connection

ORACLE = entry_point.oracle_sql()
QUERIES = entry_point.queries()


@pytest.fixture(scope="module")
def duck(small_dir):
    return oracle_connection(small_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, small_dir, duck, name):
    assert compare(QUERIES[name](spark, small_dir).toArrow(), duck.sql(ORACLE[name]).to_arrow_table()) == ""


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLE))
def test_has_rows(spark, small_dir, name):
    assert not QUERIES[name](spark, small_dir).isEmpty()


def test_entry(spark):
    assert {r["risk_grade"] for r in entry_point.entry(spark).collect()} <= set(fx.RISK_GRADES)
