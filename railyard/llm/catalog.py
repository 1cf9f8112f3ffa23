"""Queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from railyard.llm import (
    audit, chat, decontam, htmltext, langid, levels, licenses, packing, pii, quality, secrets, simhash, subvectors,
)
from railyard.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return register


def word_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), word_vocabulary())


@query("op2_simhash_near_dedup")
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (4 words, 4 bits)."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4).select(
        "doc_id", "fingerprint", "component_id")


@query("op6_line_frequency_quality", quality.SQL)
def op6_line_frequency_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "removed_words")


@query("op8_license_diagonals", licenses.SQL)
def op8_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template spans of every document."""
    return licenses.license_labels(table(spark, sf_dir, "documents"))


@query("op9_snapshot_collapse", chat.SQL)
def op9_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation, rendered."""
    return chat.formatted(table(spark, sf_dir, "conversations"))


@query("op7_private_data_boosting")
def op7_private_data_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.private_report(table(spark, sf_dir, "documents"))


@query("op10_secret_ownership")
def op10_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query("op3_latent_decontamination")
def op3_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_language_evidence")
def op4_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page."""
    return langid.identified(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


@query("op5_html_layout")
def op5_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return htmltext.rendered(table(spark, sf_dir, "pages"))


@query("op11_online_levels")
def op11_online_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in windows of 2048 ids."""
    return levels.pack_online(table(spark, sf_dir, "documents"), word_vocabulary())


@query("op12_filter_audit", audit.SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove at each step of all 120 orders, by source."""
    return audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_subvector_clusters", subvectors.SQL)
def op13_subvector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after three rounds from 16 centroids."""
    return subvectors.clustered(table(spark, sf_dir, "embeddings"))
