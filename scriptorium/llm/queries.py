"""Queries of the training-data operators over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base_sql, decontam, html_text, lang_id, licenses, line_dedup, lm, media, mixing, near_dup, pii
from .common import read


def op1_disclosure_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_segment_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.duplicate_lines(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.selectExpr("doc_id", "n_lines", "n_removed", "concat_ws(',', transform(removed, x -> cast(x as string))) AS removed")


def op3_setsketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), k=2, percent=80)


def op4_url_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op5_context_mixing_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_model_scores(read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.language_id(read(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op7_iso_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(read(spark, sf_dir, "documents", "doc_id", "text"))


def op8_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op9_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(read(spark, sf_dir, "documents", "doc_id", "text"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def base1_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of op1's identifiers."""
    return pii.personal_data(read(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


def base2_exact_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2 with no edits tolerated."""
    return line_dedup.duplicate_lines(read(spark, sf_dir, "documents", "doc_id", "text"), per_edit=10**9).select("doc_id", "n_lines", "n_removed")


def base7_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads that op7 reads back from its files."""
    return media.media_columns(read(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256")


def base8_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of op8's mix."""
    return mixing.mix(read(spark, sf_dir, "documents", "doc_id", "text", "source")).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def base10_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and labels of op10's exact phrases."""
    return licenses.license_scan(read(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_disclosure_pii, op2_segment_line_dedup, op3_setsketch_near_dup, op4_url_differencing, op5_context_mixing_lm, op6_crf_language_id, op7_iso_media, op8_sainte_lague_mix, op9_spaced_seed_decontamination, op10_license_scan, pipeline)
    base = (base1_identifiers, base2_exact_lines, base7_payloads, base8_targets, base10_phrases)
    return {f.__name__: f for f in (*own, *base)}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_setsketch_near_dup": base_sql.NEAR_DUP,
        "op9_spaced_seed_decontamination": decontam.ORACLE,
        "base1_identifiers": base_sql.IDENTIFIERS,
        "base2_exact_lines": base_sql.EXACT_LINES,
        "base7_payloads": base_sql.PAYLOADS,
        "base8_targets": base_sql.TARGETS,
        "base10_phrases": base_sql.PHRASES,
    }
