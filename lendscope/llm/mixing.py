"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope.llm.tables import columns, own_name, written
from lendscope.llm.words import WORD_PATTERN

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix"
RANGE_ROWS = 2_000
KEY_DIGITS = 13  # hex digits of a random key: 52 bits


def word_count(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: (source, source_size, documents, target, ranges).

    ``sizes`` has (source, size). Sources are ordered by code point, null last, and take the
    weights in turn. Targets add up to ``share`` of all sizes, but none exceeds ``max_repeats``
    times its source: what is cut off goes to the others by weight until none is above. With
    sources ordered by limit per weight that has a closed form: the first m stay at their limits,
    and the rest share what is left, where m is the first place at which the level fits. If
    every source reaches its limit, that is the target. Windows here run over one row per source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    capped = sums.withColumn("weight", weight).withColumn("cap", max_repeats * F.col("source_size").cast("double"))
    everything = Window.partitionBy(F.lit(0))
    up_to = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = up_to.rowsBetween(Window.unboundedPreceding, -1)
    on = up_to.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(on))
    levels = capped.withColumn("level", level)
    # Before the first place that fits, sources are at their limits; from there on, the level holds.
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    shared = F.first(fits, ignorenulls=True).over(up_to.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * shared, F.col("cap")))
    ranges = F.ceil(F.col("documents") / RANGE_ROWS).cast("long")
    return levels.select("source", "source_size", "documents", target.alias("target"), ranges.alias("ranges"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
        max_repeats: int = MAX_REPEATS, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """How much of each document a mix takes: (doc_id, size, source_size, target, taken), and the columns ``keep``.

    ``documents`` has (doc_id, source, text). A source takes its documents whole as often as its
    target holds its size, and once more in an order of random keys until its budget is used
    up; the document at the cut gives its first words. ``taken`` is the number of words, repeats counted,
    and its sum per source is the target rounded to a whole number.

    Keys are hashes of the seed and doc_id, so reruns agree. Each source is cut at equal steps of the
    key into ranges of about RANGE_ROWS documents; running sums are taken inside a range and
    added to the total of the ranges before it, so no source, however hot, lies in one task.
    Texts are counted in the scan and never shuffled. Null texts and texts without words have size 0
    and nothing taken. Rows that share doc_id share a key; they are ordered by size, and equal rows
    take their places in any order, which changes no result.
    """
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, KEY_DIGITS)
    key = F.conv(digits, 16, 10).cast("long")
    sized = written(documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"), *keep))
    sources = written(source_targets(sized, weights, share, max_repeats))
    named = sources.withColumnRenamed("source", "its_source")
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    span = F.col("key") / F.lit(float(16**KEY_DIGITS))
    rows = rows.withColumn("range", F.floor(span * F.col("ranges")).cast("long"))
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = written(sums.select(F.col("source").alias("its_source"), F.col("range").alias("its_range"),
                         F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_start")))
    rows = rows.join(starts, F.col("source").eqNullSafe(F.col("its_source")) & (F.col("range") == F.col("its_range")))
    within = (Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("range_start") + F.coalesce(F.sum("size").over(within), F.lit(0))
    budget = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    left = budget - full * F.col("source_size")
    taken = full * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), left - start))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), *keep)


def mixed_documents(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
                    max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The documents that a mix is made of: a row for each time that a document is taken.

    A document taken in part (one per source at most) has its first words only. Documents without
    words carry nothing into a mix and are left out. Columns are those of ``documents``. Rows are known by a number of their
    own, so those without doc_id or that repeat one are each taken as the plan says.
    """
    row = own_name(documents, "its_row")
    numbered = written(documents.withColumn(row, F.monotonically_increasing_id()))
    plan = mix(numbered.select("doc_id", "source", "text", row), weights, share, max_repeats, seed, (row,))
    plan = plan.where("taken > 0").select(row, F.col("size").alias("its_size"), F.col("taken").alias("its_taken"))
    rows = numbered.join(plan, row)
    whole = F.floor(F.col("its_taken") / F.col("its_size")).cast("int")
    part = (F.col("its_taken") - whole * F.col("its_size")).cast("int")
    parts = F.concat(F.array_repeat(F.lit(0), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    rows = rows.withColumn("its_part", F.explode(parts))
    words = F.array_join(F.slice(F.regexp_extract_all(F.col("text"), F.lit(f"({WORD_PATTERN})")), 1, F.col("its_part")), " ")
    text = F.when(F.col("its_part") > 0, words).otherwise(F.col("text"))
    return rows.withColumn("text", text).select(*columns(documents.columns))
