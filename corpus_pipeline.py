"""Pipeline over ``documents``: language, near copies, benchmark passages, personal data, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from playlens.llm import decontamination, jaccard_join, language_id, pii, queries, sentence_pieces  # noqa: E402
from playlens.llm.common import materialise, table  # noqa: E402


#: Rows and bytes handed to a Python worker at a time. Stages of one application share their
#: executors, and what a batch once took in a JVM or a worker is kept for the next ones.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 250, "spark.sql.execution.arrow.maxBytesPerBatch": 1 << 20}


def _small_batches(spark: SparkSession) -> None:
    for key, most in BATCH.items():
        spark.conf.set(key, str(most))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined with a sufficient margin."""
    _small_batches(spark)
    return language_id.drop_rejected(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the shingle Jaccard join. As a stage on word
    shingles without a contract of its own it takes five words and 0.8."""
    _small_batches(spark)
    return jaccard_join.keep_one(docs, percent=80, width=5)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates."""
    _small_batches(spark)
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal data, and the new text's length."""
    _small_batches(spark)
    return pii.replace_in_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with digests of the ids and of the decoded text."""
    _small_batches(spark)
    return sentence_pieces.encode(docs, queries.piece_model_path(), with_decoded=False)


STAGES = [("language ID", language), ("n-gram Jaccard join", near_copies),
          ("benchmark decontamination", benchmark_passages), ("PII", personal_data),
          ("SentencePiece", pieces)]

#: Compression sizes and the vocabulary's segmentation have no SQL form; tests/llm compares
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
