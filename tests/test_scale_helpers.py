"""The parallel paths for large groups give the same rows as the plain ones."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendscope.operators import evaluation, neighbours, sampling, sequences
from lendscope.operators.quantiles import exact_quantiles
from lendscope.operators.running import dealt_by_range, number_rows, running_counts
from lendscope.operators.shared_storage import cut_lineage, scratch_path, shared_folder


@pytest.mark.parametrize("accuracy, values", [(10_000, 2_000_000), (60, 10)])
@pytest.mark.parametrize("n, hot", [(1, 0), (7, 0), (3000, 0.4)])
def test_exact_quantiles(spark, accuracy, values, n, hot):
    rng = np.random.default_rng(n)
    x = rng.normal(size=n)
    x[: int(n * hot)] = 0.25
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(4)
    qs = (0, 0.1, 0.35, 0.5, 0.99, 1)
    got = exact_quantiles(df, {str(q): ("x", q) for q in qs}, accuracy, values)
    assert [got[str(q)] for q in qs] == pytest.approx([np.percentile(x, 100 * q) for q in qs])


def test_quantile_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "x double"), {"m": ("x", 0.5)}) == {"m": None}


def test_running_counts_in_ranges(spark):
    rng = np.random.default_rng(2)
    rows = pd.DataFrame({"k": rng.integers(0, 3, 2000), "v": np.round(rng.random(2000), 3), "l": rng.integers(0, 2, 2000)})
    rows.loc[rng.random(2000) < 0.3, "v"] = 0.5
    df = spark.createDataFrame(rows)
    both = [
        running_counts(df, ["k"], "v", {"pos": F.col("l"), "all": F.lit(1)}, previous=True, group_rows=limit)
        .toPandas().sort_values(["k", "v"]).reset_index(drop=True)
        for limit in (10**6, 20)
    ]
    pd.testing.assert_frame_equal(*both, check_dtype=False)


def test_row_numbers_of_a_hot_key_with_a_hot_time(spark):
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"k": np.where(rng.random(2000) < 0.4, 0, rng.integers(1, 99, 2000)),
                         "t": rng.integers(0, 50, 2000), "tie": rng.permutation(2000)})
    rows.loc[rng.random(2000) < 0.3, "t"] = 7
    df = spark.createDataFrame(rows)
    both = [
        number_rows(df, "k", ["t", "tie"], group_rows=limit).select("k", "t", "tie", "row_no").toPandas()
        .sort_values(["k", "row_no"]).reset_index(drop=True)
        for limit in (10**6, 100)
    ]
    pd.testing.assert_frame_equal(*both)


@pytest.mark.parametrize("build", [sequences.block_sequences, sequences.sliding_sequences])
def test_sequences_of_a_hot_key(spark, build):
    rows = [(0, i, float(i)) for i in range(100)] + [(1, i, float(-i)) for i in range(5)] + [(2, 0, 0.0)]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    small = {"group_rows": 20} | ({"chunk_rows": 7} if build is sequences.sliding_sequences else {})
    plain, cut = ({tuple(map(str, r)) for r in build(df, "k", ["t"], ["v"], 3, **o).collect()} for o in ({}, small))
    assert plain == cut
    assert len(plain) == (34 if build is sequences.block_sequences else 101)


def test_roc_points_in_ranges(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(pd.DataFrame({"model": "m", "label": rng.integers(0, 2, 800), "score": np.round(rng.random(800), 2)}))
    plain, cut = (sorted(map(tuple, evaluation.roc_points(df, group_rows=limit).collect())) for limit in (10**6, 10))
    assert plain == cut


@pytest.mark.parametrize("leaf_rows, visitors", [(5000, 20000), (25, 40)])
def test_neighbours_match_brute_force(spark, leaf_rows, visitors):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(400, 3)), 1)
    x[:130] = x[0]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=range(400)))
    points = df.groupBy("a", "b", "c").agg(F.min("id").alias("key"), F.count(F.lit(1)).alias("copies")).withColumn("wanted", F.col("key") % 2 == 0)
    points = cut_lineage(points)
    found = neighbours.nearest_neighbours(points, ["a", "b", "c"], 5, leaf_rows, visitors).collect()
    wanted = {r["key"]: np.array([r["a"], r["b"], r["c"]]) for r in points.filter("wanted").collect()}
    assert {r["key"] for r in found} == set(wanted)
    for r in found:
        near = np.sort(((x - wanted[r["key"]]) ** 2).sum(1))[1:6]
        assert np.sort([((np.array(v) - wanted[r["key"]]) ** 2).sum() for v in r["neighbours"]]) == pytest.approx(near)


def test_sample_by_cut_equals_sorted_sample(spark):
    df = spark.range(5000).withColumnRenamed("id", "loan_id")
    plain, cut = ({r[0] for r in sampling.hash_sample(df, 321, sorted_rows=limit).collect()} for limit in (10**6, 100))
    assert plain == cut and len(plain) == 321
    assert sorted(r[0] for r in sampling.head_rows(df, 7, sorted_rows=10).collect()) == list(range(7))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))


@pytest.mark.parametrize("n", [50, 700, 1500, 1990])
def test_head_rows_with_nulls_and_nan(spark, n):
    rng = np.random.default_rng(8)
    keys = [None if u < 0.33 else float("nan") if u < 0.4 else float(int(u * 10**6)) for u in rng.random(2000).tolist()]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "loan_id double, i int")
    plain, cut = (sorted(str(r[0]) for r in sampling.head_rows(df, n, sorted_rows=limit).collect()) for limit in (10**6, 100))
    assert plain == cut and len(plain) == n


def test_a_sketch_that_misses_is_widened(spark, monkeypatch):
    from lendscope.operators import quantiles

    x = np.arange(5000.0)
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(4)
    monkeypatch.setattr(quantiles, "_ends", lambda low, high, slack, ends=quantiles._ends: [0.9, 0.95] if slack < 0.3 else ends(low, high, slack))
    assert exact_quantiles(df, {"m": ("x", 0.25)}, accuracy=100) == {"m": np.percentile(x, 25)}


def test_row_numbers_by_a_text_column(spark):
    rng = np.random.default_rng(9)
    rows = [(int(k), f"{m:02d}/01/{2000 + y}", int(t)) for k, m, y, t in zip(rng.random(1500) < 0.5, rng.integers(1, 13, 1500), rng.integers(0, 9, 1500), rng.permutation(1500))]
    df = spark.createDataFrame([*rows, (1, None, -1)], "k int, period string, tie int")
    plain, cut = ({tuple(map(str, r)) for r in number_rows(df, "k", ["period", "tie"], group_rows=limit).collect()} for limit in (10**6, 100))
    assert plain == cut and len(plain) == 1501


def test_one_text_value_on_a_whole_key_is_shared_among_tasks(spark):
    rows = [("big", "2020/01", i) for i in range(4000)] + [(None, "2020/01", -i) for i in range(900)] + [("small", None, i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, period string, v int").repartition(5)
    sizes = [r["count"] for r in dealt_by_range(df.where("k = 'big'"), ["k", "period"], 16).groupBy("_range").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 4000 / 8
    numbered = number_rows(df, "k", ["period"], group_rows=500)
    assert numbered.columns == ["k", "period", "v", "row_no"]
    got = numbered.toPandas()
    for key, n in (("big", 4000), ("small", 5)):
        assert sorted(got.row_no[got.k == key]) == list(range(1, n + 1))
    assert sorted(got.row_no[got.k.isna()]) == list(range(1, 901))
    assert sorted(got.v) == sorted(r[2] for r in rows)
    by_value = number_rows(df, "k", ["period", "v"], group_rows=500).where("k = 'big'")
    assert by_value.filter("row_no = v + 1").count() == 4000


def test_macro_join_does_not_shuffle_loans(spark):
    from lendscope.operators import macro

    loans = spark.range(1000).select("id", (F.col("id") % 9 + 2000).cast("int").alias("issue_year"), F.lit(1).alias("issue_quarter"))
    table = spark.range(9).select((F.col("id") + 2000).cast("int").alias("year"), F.lit(1).alias("quarter"), F.lit(2.5).alias("gdp"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = macro.join_macro(loans, table)
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.filter("gdp = 2.5").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    with pytest.raises(ValueError):
        macro.join_macro(loans, table, most_quarters=8)


def test_projected_neighbours_recall(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(3000, 10)) @ rng.normal(size=(10, 10)), 2)
    x[:40] = x[0]
    df = spark.createDataFrame(pd.DataFrame(x, columns=[f"f{i}" for i in range(10)]).assign(id=range(3000)))
    names = [f"f{i}" for i in range(10)]
    points = df.groupBy(*names).agg(F.min("id").alias("key"), F.count(F.lit(1)).alias("copies")).withColumn("wanted", F.col("key") % 5 == 0)
    found = neighbours.projected_neighbours(points, names, 5, leaf_rows=300).collect()
    assert {r["key"] for r in found} == {r["key"] for r in points.filter("wanted").collect()}
    hits = 0
    for r in found:
        near = np.sort(((x - x[r["key"]]) ** 2).sum(1))[1:6]
        got = np.sort([((np.array(v) - x[r["key"]]) ** 2).sum() for v in r["neighbours"]])
        assert len(got) == 5 and (got >= near - 1e-6).all()
        hits += np.isclose(got[:, None], near[None, :]).any(axis=1).sum()
    assert hits >= 0.85 * 5 * len(found)
    exact = neighbours.projected_neighbours(points, names, 5, leaf_rows=5000).collect()
    assert all(np.isclose(np.sort([((np.array(v) - x[r["key"]]) ** 2).sum() for v in r["neighbours"]]),
                          np.sort(((x - x[r["key"]]) ** 2).sum(1))[1:6]).all() for r in exact)


def test_oversampling_takes_text_ids(spark):
    from lendscope.operators import oversampling

    df = spark.range(300).select(F.concat(F.lit("L"), "id").alias("loan_id"), F.rand(3).alias("a"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    assert oversampling.synthetic_minority(df, ["a"], "y").count() == 240


@pytest.mark.parametrize("dimensions", [17, 21])
def test_projected_neighbours_recall_in_many_dimensions(spark, dimensions):
    """Recall of 0.9 against all distances, at the number of features that the models have."""
    rng = np.random.default_rng(dimensions)
    x = rng.normal(size=(4000, dimensions)) @ rng.normal(size=(dimensions, dimensions)) + 5 * rng.normal(size=(6, dimensions))[rng.integers(0, 6, 4000)]
    names = [f"f{i}" for i in range(dimensions)]
    points = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(key=range(4000), copies=1, wanted=True))

    def recall():
        found = neighbours.projected_neighbours(points, names, 5, leaf_rows=400).collect()
        assert len(found) == 4000
        hits = 0
        for r in found:
            near = np.sort(((x - x[r["key"]]) ** 2).sum(1))[1:6]
            got = ((np.array(r["neighbours"]) - x[r["key"]]) ** 2).sum(1)
            assert len(got) == 5 and (np.diff(got) >= -1e-9).all()
            hits += np.isclose(got[:, None], near[None, :]).any(axis=1).sum()
        return hits / (5 * len(found))

    assert recall() >= 0.9


def test_projected_neighbours_of_rows_no_direction_tells_apart(spark):
    """One column drowns the others in rounding: rows stay with near ones, and none loses its neighbours."""
    rows = [(i, 1, True, 1e17, float(i)) for i in range(600)]
    points = spark.createDataFrame(rows, "key long, copies long, wanted boolean, a double, b double")
    found = neighbours.projected_neighbours(points, ["a", "b"], 2, leaf_rows=50).collect()
    assert len(found) == 600
    for r in found:
        near = sorted((j - r["key"]) ** 2 for j in (r["key"] + s for s in (-2, -1, 1, 2)) if 0 <= j < 600)[:2]
        assert sorted((v[1] - r["key"]) ** 2 for v in r["neighbours"]) == near


def test_projected_neighbours_of_few_rows(spark):
    one = spark.createDataFrame([(7, 3, True, 1.0)], "key long, copies long, wanted boolean, a double")
    assert [r["neighbours"] for r in neighbours.projected_neighbours(one, ["a"], 5).collect()] == [[[1.0], [1.0]]]
    assert neighbours.projected_neighbours(one.limit(0), ["a"], 5).count() == 0
