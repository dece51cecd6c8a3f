"""Readers, sinks, ingestion plans and streams."""

import datetime as dt
import pathlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from lendscope import fixed_values as fx
from lendscope.operators import features
from lendscope.plans import ingestion
from lendscope.sources import readers, schemas, sinks
from lendscope.streaming import features as streaming


@pytest.fixture
def loans(spark):
    rows = [
        (1, 1000.0, "13.5%", "B", "Fully Paid", "Dec-2011", 10.0, "40.0%"),
        (2, 2000.0, "n/a", "C", "Charged Off", "Jan-2012", None, "90.5%"),
        (3, 1500.0, "9%", "A", "Current", "Mar-2012", 5.0, "1%"),
        (4, 800.0, "5%", "H", "Default", "bad", 55.0, None),
    ]
    return spark.createDataFrame(
        rows, "id long, loan_amnt double, int_rate string, grade string, loan_status string, issue_d string, dti double, revol_util string")


@pytest.fixture
def macro_table(spark):
    return spark.createDataFrame([(2011, 4, 8.5, 1.0, 0.1, 3.0), (2009, 4, 9.9, -2.0, 0.2, 6.0)], schemas.macro_schema())


def test_missing_path(spark):
    with pytest.raises(AnalysisException):
        readers.read_csv(spark, "/no/such/file.csv", schemas.snapshot_schema())


def test_schema_shapes():
    assert [len(s().fields) for s in (schemas.snapshot_schema, schemas.loan_book_schema, schemas.monthly_performance_schema)] == [12, 23, 8]
    assert schemas.snapshot_column_names()[0] == "row_id"


def test_column_contract(loans):
    kept, missing = readers.column_contract(loans, ["loan_amnt", "fico"], "loan_status")
    assert kept.columns == ["loan_amnt", "loan_status"] and missing == ["fico"]


def test_absent_artifact_is_empty(spark, tmp_path):
    assert readers.read_artifact(spark, str(tmp_path / "none.json"), schemas.macro_schema()).count() == 0


def test_star_tables_only_with_columns(loans):
    tables = sinks.star_tables(loans.withColumnRenamed("id", "loan_id"))
    assert tables["fact_loans"].columns == ["loan_id", "loan_amnt", "int_rate"]
    assert "fact_loans" in tables and tables["dim_time"].columns == ["loan_id"]
    assert set(sinks.star_tables(loans.select("dti"))) == {"dim_borrower"}


def test_jdbc_sink_replaces_prefixed_tables(loans, monkeypatch):
    """No database is contacted: the writer call is recorded."""
    calls = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode=None, properties=None: calls.append((table, mode, properties)))
    written = sinks.write_feature_store(loans, "loans", "jdbc:x", "jdbc", properties={"user": "u"})
    assert written == [c[0] for c in calls] and written[0] == "loans_features"
    assert all(mode == "overwrite" and p["numPartitions"] == "8" and p["user"] == "u" for _, mode, p in calls)


def test_failed_sink_raises(loans, monkeypatch):
    def refuse(self, *a, **k):
        raise RuntimeError("no connection")

    monkeypatch.setattr(DataFrameWriter, "jdbc", refuse)
    with pytest.raises(RuntimeError):
        sinks.write_feature_store(loans, "loans", "jdbc:x", "jdbc")
    with pytest.raises(ValueError):
        sinks.write_feature_store(loans, "loans", "x", "xml")


def test_rebuild_policy(spark, loans, tmp_path):
    base = str(tmp_path)
    sinks.write_star_parquet(loans, base, "d")
    sinks.write_star_parquet(loans.limit(1), base, "d", rebuild=False)
    assert spark.read.parquet(f"{base}/d_features.parquet").count() == 4
    sinks.write_star_parquet(loans.limit(1), base, "d")
    assert spark.read.parquet(f"{base}/d_features.parquet").count() == 1


def test_loan_book_ingestion(spark, loans, macro_table, tmp_path):
    path = str(tmp_path / "loans.csv")
    loans.write.option("header", True).csv(path)
    written = ingestion.ingest_loan_book(spark, path, macro_table, str(tmp_path / "store"))
    rows = {r["loan_id"]: r for r in spark.read.parquet(written[0]).collect()}
    assert {int(k): r["is_default"] for k, r in rows.items()} == {1: 0, 2: 1, 4: 1}
    first = rows["1"]
    assert (first["int_rate"], first["unemployment_rate"], first["issue_date"]) == (13.5, 8.5, dt.date(2011, 12, 1))
    assert rows["4"]["unemployment_rate"] is None and rows["4"]["grade_numeric"] is None
    assert rows["2"]["int_rate"] is not None


def test_snapshot_ingestion(spark, macro_table, tmp_path):
    rows = [(i, i % 2, 0.1 * i, 15 + i, 0, 0.5, 1000.0 * i, 2, 98 if i == 3 else 0, 1, 0, 1.0) for i in range(1, 9)]
    rows.append((99, *rows[0][1:]))
    path = str(tmp_path / "snapshot.csv")
    spark.createDataFrame(rows, schemas.snapshot_schema()).write.option("header", True).csv(path)
    written = ingestion.ingest_snapshot(spark, path, macro_table, str(tmp_path / "store"))
    table = spark.read.parquet(written[0])
    assert table.count() == 8 and table.filter("unemployment_rate = 9.9").count() == 8
    assert table.filter("loan_id = 99").isEmpty() and table.agg({fx.LATE_90: "max"}).first()[0] == 0
    _, target = readers.read_features(spark, written[0], "snapshot")
    assert target == fx.SNAPSHOT_TARGET


def test_stream_gives_the_batch_features(spark, tmp_path):
    rows = [(i, i % 2, 0.1 * i, 15 + i, i % 3, 0.5, 1000.0 * i, 2, 98 if i == 3 else 0, 1, 0, 1.0) for i in range(1, 9)]
    raw = spark.createDataFrame(rows, schemas.snapshot_schema())
    raw.write.option("header", True).csv(str(tmp_path / "in"))
    fit = features.fit_snapshot(raw)
    stream = streaming.snapshot_stream(streaming.csv_stream(spark, str(tmp_path / "in"), schemas.snapshot_schema()), fit)
    query = streaming.append_parquet(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    batch = features.snapshot_features(raw.withColumnRenamed("row_id", "loan_id"), fit)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, batch.collect()))


def _files(path):
    return {f: f.stat().st_mtime_ns for f in pathlib.Path(path).rglob("*.parquet")}


def test_rebuilding_one_year_leaves_the_others(spark, tmp_path):
    """Flat and star tables in folders by year: a rebuild of one year touches that year's files alone."""
    def build(years, amount):
        listed = "array(" + ", ".join(map(str, years)) + ")"
        return spark.range(60).selectExpr("id AS loan_id", f"element_at({listed}, CAST(id % {len(years)} AS INT) + 1) AS issue_year",
                                          f"{amount}D + id AS loan_amnt", "'A' AS grade", "id % 7 AS term")

    base = str(tmp_path / "store")
    paths = sinks.write_feature_store(build([2015, 2016, 2017], 100), "loans", base, partition_by="issue_year")
    before = {p: _files(p) for p in paths}
    again = sinks.write_feature_store(build([2016, 2018], 9000), "loans", base, partition_by="issue_year")
    assert again == paths
    flat = spark.read.parquet(paths[0])
    counts = {r[0]: (r[1], r[2] > 5000) for r in flat.groupBy("issue_year").agg(F.count("*"), F.min("loan_amnt")).collect()}
    assert counts == {2015: (20, False), 2016: (30, True), 2017: (20, False), 2018: (30, True)}
    for path in paths:
        table, old = spark.read.parquet(path), before[path]
        if "issue_year" in table.columns:
            kept = {f: t for f, t in old.items() if "2016" not in str(f.parent)}
            assert kept and kept.items() <= _files(path).items()
            assert table.count() == 100
    kept = sinks.write_feature_store(build([2015], 1), "loans", base, partition_by="issue_year", rebuild=False)
    assert kept == paths and spark.read.parquet(paths[0]).where("issue_year = 2015").count() == 20
