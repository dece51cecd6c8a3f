"""Reading tables, writing them between steps, and names that clash with nothing."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.operators.shared_storage import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: later steps never redo the work, and its size is known."""
    return cut_lineage(df)


def written_counting(df: DataFrame, rows: Column) -> tuple[DataFrame, int]:
    """``written``, and the number of its rows for which ``rows`` holds.

    They are counted in the table: an observation would leave the session with a member that Spark cannot send to tasks.
    """
    out = written(df)
    return out, out.where(rows).count()


def release(spark: SparkSession) -> None:
    """Let go of finished steps between rounds.

    Spark drops shuffle files and broadcasts of a step once the driver has collected its plan as garbage. Many short rounds
    may pass before it does, and their files and plans would pile up on disk and in the driver's heap.
    """
    for _ in range(2):  # the first lets go of frames, the second of what their plans held
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def columns(names: list[str], *left_out: str) -> list[Column]:
    """Columns by name, whatever characters the names have."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names if n not in left_out]


def own_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def partitions(spark: SparkSession, rows: int, each: int) -> int:
    """How many partitions hold ``each`` of the rows; no fewer than the session's shuffles have."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))
