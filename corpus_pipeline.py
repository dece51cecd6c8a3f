"""Documents to packed training sequences: five stages, each written as Parquet and read by the next.

Stages take (spark, docs, sf_dir). All but the last return the columns of documents; the last one
returns the pieces of all sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.llm import line_dedup, mixing, near_dedup, packing, quality
from lendscope.llm.queries import vocabulary
from lendscope.llm.tables import columns, table, written


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score 0.3 or more), unchanged."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their source's boilerplate lines; n_chars follows. No document goes, and no text vanishes because its
    copies make up much of a source: copies count once, and one near copy keeps the lines that all share."""
    kept = line_dedup.drop_boilerplate(docs, one_stays="doc_id")
    return kept.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*columns(docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest doc_id; documents without words stay."""
    return near_dedup.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; n_chars follows where one is taken in part."""
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(*columns(docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.packed_documents(docs, vocabulary())


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_boilerplate),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack),
]

#: Scores of a fitted model and MinHash links have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. Each result but the last is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
