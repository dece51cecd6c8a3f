"""Joins with a table of one row per key, in which no hot key lies in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.tables import own_name

SALTS = 32
HOT_SHARE = 1_000  # a key is hot if it has over a thousandth of all rows, so there are fewer than that many
HOT_ROWS = 2_000


def hot_keys(counts: DataFrame, keys: list[str], total: int) -> DataFrame | None:
    """The keys with over a thousandth of all rows (HOT_ROWS at least), None if there is none.

    ``counts`` has (keys, n). There are fewer than HOT_SHARE hot keys, whatever the input, so they may be broadcast.
    """
    hot = counts.where(F.col("n") > max(HOT_ROWS, total // HOT_SHARE)).select(*keys)
    rows = hot.collect()
    return counts.sparkSession.createDataFrame(rows, hot.schema) if rows else None


def spread_lookup(rows: DataFrame, table: DataFrame, keys: list[str], spread: Column, counts: DataFrame, total: int) -> DataFrame:
    """``rows`` left-joined with ``table``, which has one row per key.

    Rows of a hot key are dealt over SALTS tasks by a hash of ``spread`` and the table's row for it is copied to each of
    them; all other keys are joined as they are, in the same shuffle. ``counts`` (keys, n) has the rows per key and
    ``total`` their sum. Rows with a null key find nothing.
    """
    found = hot_keys(counts, keys, total)
    if found is None:
        return rows.join(table, keys, "left")
    hot, salt = own_name(rows, "is_hot"), own_name(rows, "its_salt")
    flags = F.broadcast(found.withColumn(hot, F.lit(True)))
    dealt = rows.join(flags, keys, "left").withColumn(
        salt, F.when(F.col(hot), F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(0).cast("int")).drop(hot)
    every = F.when(F.col(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = table.join(flags, keys, "left").withColumn(salt, F.explode(every)).drop(hot)
    return dealt.join(copied, [*keys, salt], "left").drop(salt)
