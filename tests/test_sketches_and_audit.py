"""Audits gathered while cleaning, and rank sketches kept per partition."""

import pathlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import cleaning, rank_sketches


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id long, y int, a double, _copies string")


@pytest.mark.parametrize("id_column", ["id", None])
def test_audit_equals_row_flow(spark, id_column):
    """Repeated rows, rows without a target and a column of the counter's name."""
    df = _rows(spark, [(i, (0, 1, None)[i % 3], (1.0, None, 3.0)[i % 5 % 3], "x") for i in range(60)] + [(3, 0, 1.0, "x")] * 4 + [(70, None, None, None)])
    cleaned, audit = cleaning.clean_with_audit(df, "y", id_column, "exact")
    plain = cleaning.clean(df, "y", id_column, "exact")
    assert cleaned.schema.names == plain.schema.names
    assert sorted(map(tuple, cleaned.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    renamed = df.withColumnRenamed("_copies", "text")
    assert audit.collect() == cleaning.row_flow(renamed, "y", id_column).collect()


def test_audit_of_an_empty_table(spark):
    cleaned, audit = cleaning.clean_with_audit(_rows(spark, []), "y", "id")
    assert cleaned.count() == 0
    assert audit.first()["initial_rows"] == audit.first()["final_rows"] == 0


def _stamps(folder):
    return {str(p): p.stat().st_mtime_ns for p in pathlib.Path(folder).rglob("*.parquet")}


def test_sketches_follow_partitions(spark, tmp_path):
    """A rebuilt partition replaces its own sketch, leaves the others' files alone, and moves the medians."""
    path = str(tmp_path / "sketches")
    df = spark.range(30_000).select((F.col("id") % 3).cast("int").alias("year"), F.col("id").cast("double").alias("a"),
                                    F.when(F.col("id") % 2 == 0, F.col("id")).alias("b"), F.lit(None).cast("double").alias("c"))
    rank_sketches.update_sketches(df, ["a", "b", "c"], "year", path)
    found = rank_sketches.stored_medians(spark, path, ["a", "b", "c"])
    assert set(found) == {"a", "b"}
    assert abs(found["a"] - 15_000) < 300 and abs(found["b"] - 15_000) < 300
    before = {p: t for p, t in _stamps(path).items() if "year=2" not in p}
    assert len(before) == 2
    rank_sketches.update_sketches(df.where("year = 2").withColumn("a", F.lit(1e6)), ["a", "b", "c"], "year", path)
    after = _stamps(path)
    assert {p: after[p] for p in before} == before
    moved = rank_sketches.merged_quantiles(spark.read.parquet(path), {"half": ("a", 0.5), "most": ("a", 0.9)}).first()
    kept = np.arange(30_000)[np.arange(30_000) % 3 != 2]
    assert abs((kept <= moved["half"]).mean() * 2 / 3 - 0.5) < 0.01 and moved["most"] == 1e6


def test_sketches_skip_what_is_no_number(spark):
    df = spark.createDataFrame([(None, float("nan")), (None, float("inf")), (1, 2.0), (1, None)], "year int, a double")
    sketches = rank_sketches.partition_sketches(df, ["a"], "year")
    assert sketches.count() == 2
    assert rank_sketches.merged_quantiles(sketches, {"m": ("a", 0.5)}).first()["m"] == 2.0
    empty = rank_sketches.partition_sketches(df.limit(0), ["a"], "year")
    assert rank_sketches.merged_quantiles(empty, {"m": ("a", 0.5)}).first()["m"] is None
    with pytest.raises(ValueError):
        rank_sketches.partition_sketches(df, ["year"], "year")
