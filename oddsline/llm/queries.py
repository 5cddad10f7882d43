"""Registered queries of the text operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from oddsline.llm import (decontamination, html_text, language, mixing, near_dedup, packing, quality, repeats, runs,
                          sharding, token_counts, url_rules, whitening)
from oddsline.llm.common import table
from oddsline.llm.oracles import DECONTAMINATION_SQL, NEAR_DEDUP_SQL, QUALITY_SQL


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents at 85 % of common 5-word shingles."""
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


#: The given rules, host and start of the path, with their verdicts.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block")]


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """A verdict on the URL of every page, by given rules, else by mined ones."""
    return url_rules.filtered(table(spark, folder, "pages"), table(spark, folder, "labels"), URL_RULES)


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    return language.identified(docs, language.fit(docs))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every whole document by the 32k merge-based model."""
    import public_tokenizers

    return token_counts.token_counts(table(spark, folder, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op5_curriculum_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the words that a mix of sources takes of them, in training order."""
    rows = mixing.in_order(mixing.mixed(table(spark, folder, "documents")))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "position")


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extracted(table(spark, folder, "pages"))


def op7_kd_tree_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    return sharding.sharded(table(spark, folder, "documents"), 16)


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements, base verdict and verdict of the current policy for every document."""
    docs = table(spark, folder, "documents")
    rows = quality.judged(quality.ledger(docs, quality.learned_lexicon(docs, table(spark, folder, "labels"))))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept", "failed")


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside 10-word windows of benchmark items."""
    return decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_bwt_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the bytes of 100-byte strings that also start earlier."""
    return repeats.without_repeats(table(spark, folder, "documents"))


def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens, as few as the search finds."""
    import public_tokenizers

    pieces = packing.pieces(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    narrow = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.packed(narrow).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first 16 whitened components of every valid embedding."""
    return whitening.whitened(table(spark, folder, "embeddings"))


def op13_periodic_run_detection(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of repeated words in every document, a tenth of which get a periodic ending."""
    return runs.summarised(runs.periodic_runs(runs.with_planted_runs(table(spark, folder, "documents"))))


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_url_filters, op3_language_id, op4_token_counts, op5_curriculum_mixing,
    op6_html_extraction, op7_kd_tree_sharding, op8_quality_rules, op9_benchmark_decontamination, op10_bwt_dedup,
    op11_best_fit_packing, op12_embedding_whitening, op13_periodic_run_detection)}
ORACLES = {
    "op1_minhash_near_dedup": NEAR_DEDUP_SQL,
    "op8_quality_rules": QUALITY_SQL,
    "op9_benchmark_decontamination": DECONTAMINATION_SQL,
}
