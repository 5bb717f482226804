"""Registered queries of the operators, over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playlens.llm import (decontamination, hard_negatives, jaccard_join, language_id, licenses, pii, quality, secrets,
                          sentence_pieces, suffix_dedup, token_alignment, url_filter, warc_fixity)
from playlens.llm.common import table

#: File of the vocabulary used by the registered query and the pipeline.
PIECE_MODEL = "piece_bpe_32k.model"
#: The byte-level vocabulary that is aligned with it.
BYTE_LEVEL = "byte_bpe_50k.json"


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECE_MODEL)


def byte_level_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(BYTE_LEVEL)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op4_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with their verdict by owners."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixity audit of the pages' WARC files against a replica with damaged records."""
    return warc_fixity.op5_audit(table(spark, sf_dir, "pages"))


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text (digests) of every document."""
    return sentence_pieces.encode(table(spark, sf_dir, "documents"), piece_model_path(),
                                  with_ids=False, with_decoded=False)


def op7_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under the shingle Jaccard join."""
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


def op8_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with its personal data replaced."""
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality figures and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by compression."""
    return language_id.op10_language_id(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 200-byte strings that repeat in the corpus (digest of the rest)."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor among all embeddings."""
    return hard_negatives.op12_hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aligned groups and links of both vocabularies' tokens in every document."""
    return token_alignment.align(table(spark, sf_dir, "documents"), byte_level_path(), piece_model_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_string_tiling": op2_string_tiling,
    "op3_bloom_cascade": op3_bloom_cascade,
    "op4_secret_owners": op4_secret_owners,
    "op5_merkle_audit": op5_merkle_audit,
    "op6_sentence_pieces": op6_sentence_pieces,
    "op7_jaccard_classes": op7_jaccard_classes,
    "op8_feistel_pseudonyms": op8_feistel_pseudonyms,
    "op9_line_frequency": op9_line_frequency,
    "op10_language_id": op10_language_id,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op1_licenses": licenses.oracle_sql(),
    "op3_bloom_cascade": url_filter.oracle_sql(),
    "op5_merkle_audit": warc_fixity.oracle_sql(),
    "op4_secret_owners": secrets.oracle_sql(),
    "op9_line_frequency": quality.oracle_sql(),
    "op12_hard_negatives": hard_negatives.oracle_sql(),
}
