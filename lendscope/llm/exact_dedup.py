"""Exact duplicates: local, salted and global combining of digest groups, with DataFrame functions only."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.skew import SALTS, hot_keys, spread_lookup
from lendscope.llm.tables import columns, own_name, written


def normalised(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else; a null text is empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def sha256(body: Column) -> Column:
    return F.unhex(F.sha2(body.cast("binary"), 256))


def _bodies(documents: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, body, digest) of each row."""
    bodies = documents.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("body"))
    return bodies.withColumn("digest", digest(F.col("body")))


def _winners(bodies: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(digest, keep_id, group_size) of each distinct text, merged in stages that each compare whole texts.

    ``counts`` (digest, n) has the rows per digest, ``total`` their sum.
    """
    # Tasks combine their own copies before they send anything (the partial aggregate). A hot digest's groups are salted by
    # the task, so a text leaves a task once and is merged by up to SALTS tasks; the digests of few rows have one salt.
    hot = hot_keys(counts, ["digest"], total)
    if hot is None:
        return bodies.groupBy("digest", "body").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).drop("body")
    flagged = bodies.withColumn("task", F.spark_partition_id() % SALTS).join(
        F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    salted = flagged.withColumn("salt", F.when(F.col("hot"), F.col("task")).otherwise(0))
    salted = salted.groupBy("digest", "hot", "salt", "body").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    # Salt winners of hot digests are combined globally; all others are whole already, and their texts go no further.
    salted = written(salted.withColumn("body", F.when(F.col("hot"), F.col("body"))))
    merged = salted.where("hot").groupBy("digest", "body").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    return salted.where("not hot").select("digest", "keep_id", "group_size").union(merged.drop("body"))


def exact_groups(documents: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of (doc_id, text).

    Texts are equal when they are identical after lower-casing A-Z; a null text is empty. Of equal texts the row with the
    largest doc_id stays. ``group_size`` counts the rows of a text. A null doc_id is smaller than any other; keep_id is
    null if all rows of a text lack one. Where several rows of a text share the largest doc_id, exactly one of them is
    kept (they are alike in all that the result has). An empty table gives an empty result; texts of any length are
    compared whole, and other columns are not read, whatever their names.

    Digests only bring texts together: every stage groups by the whole text too, so two texts with one digest stay apart,
    whatever ``digest`` is.

    1. Rows without texts, (doc_id, digest, number of equal rows), tell how many rows a digest has, so which ones are hot.
    2. Tasks combine their own copies, and digest groups, salted where the digest is hot, merge what tasks send. Each text
       leaves a task once; one on a third of all rows is merged by up to SALTS tasks.
    3. The salt winners of hot digests are combined globally.
    4. Rows look up their group by digest, hot groups dealt over tasks. Digests of several texts, should there be any,
       are grouped and looked up once more by their texts.
    """
    bodies = _bodies(documents, digest)
    rows = bodies.groupBy("doc_id", "digest", F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256"))
    rows = written(rows.agg(F.count("*").alias("copies")))
    counts = written(rows.groupBy("digest").agg(F.sum("copies").alias("n")).where("n > 1"))
    total = rows.agg(F.sum("copies")).first()[0] or 0
    groups = written(_winners(bodies, counts, total))
    clashing = written(groups.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest"))
    if clashing.isEmpty():
        found = spread_lookup(rows, groups.where("group_size > 1"), ["digest"], F.col("doc_id"), counts, total)
    else:
        plain = spread_lookup(rows.join(clashing, "digest", "left_anti"), groups.join(clashing, "digest", "left_anti"),
                              ["digest"], F.col("doc_id"), counts, total)
        sha = F.sha2(F.col("body").cast("binary"), 256).alias("text_sha256")
        bodied = written(bodies.join(clashing, "digest", "left_semi").groupBy("doc_id", "digest", "body", sha).agg(F.count("*").alias("copies")))
        theirs = bodied.groupBy("digest", "body").agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size"))
        sizes = theirs.select("digest", "body", F.col("group_size").alias("n"))
        found = plain.unionByName(spread_lookup(bodied, theirs, ["digest", "body"], F.col("doc_id"), sizes, total).drop("body"))
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    own = F.col("group_size").isNull()  # the only row of its text
    keep = F.when(own, F.col("doc_id")).otherwise(F.col("keep_id"))
    return each.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                       (F.col("doc_id").eqNullSafe(keep) & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def drop_copies(documents: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns. Of rows alike in doc_id and text any one stays."""
    kept = exact_groups(documents).where("kept")
    names = [own_name(documents, n) for n in ("its_id", "its_sha256")]
    sha = F.sha2(normalised(F.col("text")).cast("binary"), 256)
    marked = documents.withColumns({names[0]: F.col("doc_id").cast("long"), names[1]: sha})
    kept = kept.select(F.col("doc_id").alias("k"), F.col("text_sha256").alias("s"))
    stays = marked.join(kept, (marked[names[1]] == kept["s"]) & marked[names[0]].eqNullSafe(kept["k"]), "left_semi")
    return stays.dropDuplicates(names).select(*columns(documents.columns))
