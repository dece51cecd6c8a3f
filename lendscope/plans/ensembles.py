"""Cutting fitted boosted trees to their first ones, by way of their saved tables."""

from __future__ import annotations

import json

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import SparkSession, functions as F

from lendscope.operators.shared_storage import scratch_path


def first_trees(spark: SparkSession, model: GBTClassificationModel, trees: int) -> GBTClassificationModel:
    """The model made of the first ``trees`` trees of ``model``.

    Boosting never changes a tree once it is there, so this is the model that a fit of so many rounds gives. Trees are numbered in
    the order they were fitted; the saved tables are filtered by that number and loaded again, and nothing is fitted.
    """
    if not 0 < trees <= model.getNumTrees:
        raise ValueError(f"cannot keep {trees} of {model.getNumTrees} trees")
    if trees == model.getNumTrees:
        return model
    whole, cut = scratch_path(spark, "trees"), scratch_path(spark, "first_trees")
    model.write().save(whole)
    stored = json.loads(spark.read.text(f"{whole}/metadata").first()["value"])
    stored["numTrees"] = trees
    spark.createDataFrame([(json.dumps(stored),)], "value string").coalesce(1).write.text(f"{cut}/metadata")
    numbers = {"data": "treeID", "treesMetadata": "_1"}
    for table, number in numbers.items():
        spark.read.parquet(f"{whole}/{table}").filter(F.col(number) < trees).write.parquet(f"{cut}/{table}")
    return GBTClassificationModel.load(cut)
