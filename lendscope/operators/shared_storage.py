"""Cutting lineage and scratch paths in the shared folder named by the session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, one below the warehouse.

    Both are shared by the driver and all executors. A machine-local folder is never used.
    """
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows read back from a Parquet table in the shared folder.

    Later steps start from that table: executor loss costs no earlier work, and its columns can
    still be pruned, which a row checkpoint does not allow. Files are packed with zstd, as
    the shared folder's space is what these tables cost.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's tables below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/run-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the run folder."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_run_folder(spark: SparkSession) -> None:
    """Delete this application's tables, when no result that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_large(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join of two frames that both grow with the data: always shuffled, neither side goes through the driver.

    Left to itself the planner judges a written table by the packed size of its files, scaled by the columns read. Repeated
    values pack so well that 576 MB of vectors once passed for less than the 10 MB up to which it broadcasts.
    """
    return left.join(right.hint("merge"), on, how)


def spread(df: DataFrame) -> DataFrame:
    """At least one partition per core for work that is heavy per row, such as training."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
