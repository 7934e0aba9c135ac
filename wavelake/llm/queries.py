"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (bpe, decontaminate, exact_dedup, html_extract, importance, langid, licenses, prefix_bpe, simhash,
               source_audit, suffix_dedup, token_files, warc)
from .common import table

#: folder of the public tokenizer files
TOKENIZERS = public_tokenizers.path("").rstrip("/")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = langid.read_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    return langid.language_report(table(spark, sf_dir, "documents"), vocabulary)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.document_token_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op7_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivative_report(table(spark, sf_dir, "pages"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_report(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.encoding_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                      public_tokenizers.PATTERN)


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_language_id, op3_suffix_dedup, op4_exact_dedup, op5_decontamination, op6_token_counts,
    op7_warc_derivatives, op8_license_scan, op9_bpe, op10_html_extraction, op11_source_audit,
    op12_importance_resampling, op13_prefix_bpe)}
ORACLES = {"op3_suffix_dedup": suffix_dedup.ORACLE_SQL, "op4_exact_dedup": exact_dedup.ORACLE_SQL,
           "op5_decontamination": decontaminate.ORACLE_SQL, "op8_license_scan": licenses.oracle_sql(),
           "op11_source_audit": source_audit.ORACLE_SQL}
