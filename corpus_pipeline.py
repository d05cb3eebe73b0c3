"""From raw documents to packed training sequences, in stages that are each written and read again.

A stage takes (spark, docs, sf_dir) and returns documents with the same columns; the last one returns pieces of
sequences. n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumetry.llm import decontamination, near_duplicates, packing, quality, substrings
from lumetry.llm.common import digest, fresh, importable, settled, table, working_tables

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _counted(docs: DataFrame) -> DataFrame:
    """With n_chars as it is now, where there is that column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels of documents that are not held out. A null
    text is scored as an empty one."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, model, quality.THRESHOLD)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id. Documents without an id stay, and a
    null text is an empty one. Of rows that repeat a doc_id and its text all stay or none."""
    importable(spark)
    id_, of_text = (fresh(name, docs.columns) for name in ("id", "digest"))
    gone = near_duplicates.near_duplicates(docs).where("doc_id <> group_id")
    gone = gone.select(F.col("doc_id").alias(id_), F.col("digest").alias(of_text))
    same = (F.col("doc_id") == F.col(id_)) & (digest(F.coalesce(F.col("text"), F.lit(""))) == F.col(of_text))
    return docs.join(gone, same, "left_anti")


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand at an earlier place as well; those of which nothing is left go. Null and empty
    texts stay."""
    importable(spark)
    done = substrings.deduplicated(docs)
    left = (F.col(f"`{done.columns[-2]}`") == 0) | F.col("text").rlike("[0-9A-Za-z\\u0080-\\uffff]")
    return _counted(done.where(left).select(*docs.columns))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words in any occurrence of a phrase of the benchmark; those of which nothing is left go. Null and
    empty texts stay."""
    return _counted(decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 ids, as pieces of documents. A null or empty text is its end id."""
    importable(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good),
    ("near_duplicates", different),
    ("substrings", unrepeated),
    ("decontamination", clean),
    ("packing", packed),
]

ORACLE_SQL = None  # no SQL for the learned and the hashed stages; tests compare them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`. What a stage has written for itself goes when its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with working_tables(spark):
            docs = settled(stage(spark, docs, sf_dir), name, keep=True)
    return STAGES[-1][1](spark, docs, sf_dir)
