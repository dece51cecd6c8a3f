"""Faults that showed on larger tables, kept small here."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import isolation, neighbours
from lendscope.operators.shared_storage import cut_lineage, join_large
from lendscope.plans import training


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_joins_are_not_broadcast(spark):
    """Equal values pack to almost nothing, so the planner would take both sides for small."""
    wide = cut_lineage(spark.range(50_000).withColumns({f"c{i}": F.lit(0.5) for i in range(20)}))
    assert "Broadcast" in _plan(wide.join(wide.select("id"), "id"))
    joined = join_large(wide, wide.select("id"), "id")
    assert "Broadcast" not in _plan(joined) and joined.count() == 50_000


def test_neighbour_search_broadcasts_nothing(spark, monkeypatch):
    points = spark.range(1200).select(F.col("id").alias("key"), F.lit(1).alias("copies"), F.lit(True).alias("wanted"),
                                      (F.col("id") % 37).cast("double").alias("a"), (F.col("id") / 41).alias("b"))
    plans = []
    monkeypatch.setattr(neighbours, "cut_lineage", lambda df: plans.append(_plan(df)) or cut_lineage(df))
    found = neighbours.projected_neighbours(points, ["a", "b"], 3, leaf_rows=100)
    plans.append(_plan(found))
    assert not [p for p in plans if "Broadcast" in p]
    assert sum("SortMergeJoin" in p for p in plans) > 1
    assert found.count() == 1200


def _plain_score(forest, row):
    total = 0.0
    for tree in forest.trees:
        node = 0
        while tree["feature"][node] >= 0:
            low = row[tree["feature"][node]] <= tree["cut"][node]
            node = tree["lower" if low else "upper"][node]
        total += tree["path"][node]
    return 2.0 ** (-total / len(forest.trees) / isolation.average_path(forest.rows_per_tree))


def test_isolation_scores_agree_with_plain_walks(spark):
    """Every tree is walked for all rows at once, gaps and a tree without a split included."""
    one = {"feature": np.array([-1]), "cut": np.zeros(1), "lower": np.array([-1]), "upper": np.array([-1]), "path": np.array([1.5])}
    df = spark.range(5000).select(F.col("id").alias("loan_id"), (F.col("id") % 91 / 7).alias("a"),
                                  F.when(F.col("id") % 10 > 0, (F.col("id") * 31 % 57).cast("double")).alias("b"))
    forest = isolation.fit_isolation_forest(df.na.drop(), ["a", "b"], trees=7, rows_per_tree=64)
    forest = isolation.IsolationForest(forest.features, (*forest.trees, one), forest.rows_per_tree)
    for r in isolation.score_isolation(df, forest).collect():
        values = [np.nan if v is None else v for v in (r["a"], r["b"])]
        assert r["iso_forest_score"] == pytest.approx(_plain_score(forest, values), rel=1e-12)


def test_forest_keeps_the_nodes_that_rows_reached(spark):
    """Walking every tree from the root at each level took half of a fit; the trees are the same without it."""
    rows = spark.range(4000).select(F.col("id"), (F.col("id") * 37 % 101 / 7).alias("a"), (F.col("id") * 53 % 97 / 5).alias("b"),
                                    ((F.col("id") * 37 % 101 > 40) & (F.col("id") * 53 % 97 < 60)).cast("int").alias("label"))
    data = training._assembler(["a", "b"]).transform(rows.withColumn(training.WEIGHT, F.lit(1.0) + F.col("label"))).coalesce(2)
    estimator = training.random_forest().setNumTrees(5)
    assert estimator.getCacheNodeIds()
    walked = estimator.copy().setCacheNodeIds(False).fit(data)
    assert estimator.fit(data).toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:] and walked.totalNumNodes > 20


def test_later_search_rounds_only_compare_what_is_new(spark):
    """Every round once compared all pairs again; leaving out those that met before gives the very lists of a plain round."""
    points = spark.range(300).select(F.col("id").alias("key"), F.lit(1).alias("copies"), F.lit(True).alias("wanted"),
                                     F.array((F.col("id") % 7).cast("long"), (F.col("id") % 5).cast("long")).alias("leaves"),
                                     *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(1 << 20)) / (1 << 10)).alias(c) for c in ("a", "b", "c")])
    homes, features, width = cut_lineage(points), ["a", "b", "c"], 4
    x = np.array([[r[c] for c in features] for r in homes.orderBy("key").collect()])

    def plain_round(known):
        met = {k: set(near) for k, near in known.items()}
        for host, near in known.items():
            for member in {*near, *(k for k, other in known.items() if host in other)}:
                met[member] |= set(near) - {member}
        return {k: sorted(others, key=lambda o: (neighbours._distances(x, [k], [o])[0], o))[:width] for k, others in met.items()}

    lists = cut_lineage(neighbours._nearest_lists(neighbours._leaf_pairs(homes, features, width, 50, 1), width))
    known = {r["key"]: [e["other"] for e in r["near"]] for r in lists.collect()}
    hosts = []
    while not hosts or hosts[-1]:
        hosts.append(neighbours._hosts(lists, homes).count())
        lists, before, known = cut_lineage(neighbours._local_join(lists, homes, features, width)), known, plain_round(known)
        rows = lists.collect()
        assert {r["key"]: [e["other"] for e in r["near"]] for r in rows} == known
        assert {r["key"]: (set(r["new"]), r["fresh"]) for r in rows} == {
            k: (set(near) - set(before[k]), len(set(near) - set(before[k]))) for k, near in known.items()}
    assert hosts[0] == 300 and len(hosts) > 3 and hosts == sorted(hosts, reverse=True)


def test_search_sample_is_merged_by_a_task(spark, monkeypatch):
    """A plain collect of the first rows by hash brought as many of every partition to the driver."""
    def refused(*_):
        raise AssertionError("collected row by row")

    points = spark.range(0, 900, 1, 7).select(F.col("id").alias("key"), F.lit(1).alias("copies"), F.lit(True).alias("wanted"),
                                              (F.col("id") % 37).cast("double").alias("a"), (F.col("id") / 41).alias("b"))
    want = [[float(r.key % 37), r.key / 41] for r in sorted(points.collect(), key=lambda r: hashlib.md5(str(r.key).encode()).hexdigest())]
    monkeypatch.setattr(type(points), "toPandas", refused)
    whole = neighbours._sample(points, 10_000, ["a", "b"])
    assert sorted(whole.tolist()) == sorted(want)
    some = neighbours._sample(points, 50, ["a", "b"])
    assert some.tolist() == want[:50]
    assert neighbours._sample(points.limit(0), 50, ["a", "b"]).shape == (0, 2)
    assert neighbours.projected_neighbours(points, ["a", "b"], 3, leaf_rows=100).count() == 900
