"""The corpus pipeline: five stages of the training-data operators.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes as Parquet in the shared folder
(deleted when the driver ends) and rereads as the next stage's ``docs``.  All but the last return the columns
of ``documents``; the last adds what the mix takes of each document.

Edge cases, stage by stage: a null or empty text is scored like any other by the
quality stage, goes in line dedup as a document left empty (a document that was
empty before stays as it is there), is near to nothing, holds no benchmark item
and takes no words of the mix; very long texts are worked on whole; of rows that
tie (equal lines, equal sets) the least doc_id stays; rows with a null doc_id stay
in the stages that name documents by their id; repeated rows of one doc_id go or
stay together; an empty table passes through; columns beyond those of
``documents`` are kept by the first four stages, whatever their names.

``ORACLE_SQL`` is None: a trained classifier cannot be written as SQL.  The
tests compare every stage with brute force on a small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logbeam.llm import op1_quality, op4_decontaminate, op5_mix, op6_line_dedup, op8_minhash
from logbeam.llm.common import table
from logbeam.session import temporary_path

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return op1_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go, and documents left empty."""
    return op6_line_dedup.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: operator 8 with the
    shingles and the similarity of its contract (two words, 0.8)."""
    return op8_minhash.keep_one(docs, shingle_words=2, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return op4_decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix of sources takes of each document, none taken left out."""
    return op5_mix.mixed_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = temporary_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
