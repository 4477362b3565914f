"""The corpus pipeline: stages applied one after the other to ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.llm.common import read_table, scratch, shared_table
from churnlens.llm.content_sort import drop_exact_duplicates
from churnlens.llm.jaccard_join import keep_one
from churnlens.llm.mixing import mixed_documents
from churnlens.llm.pieces import default_model, encoded_digests
from churnlens.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted model scores below the threshold."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of identical texts."""
    return drop_exact_duplicates(docs, keep="max")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose 5-word shingles overlap to 0.8."""
    return keep_one(docs, similar=(8, 10), size=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row, and whether they decode to its text."""
    return encoded_digests(docs, default_model())


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", near_dedup),
    ("source_mixing", mixing),
    ("sentencepiece", sentencepiece),
]
#: Trees, schedules and pieces have no SQL; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written to the shared folder and reread.

    What a stage wrote on the way is deleted once its rows are written.
    """
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
