"""Queries of the corpus operators, as the driver calls them, and their SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import exact, langid, mixing, near, packing, quality, substrings, toxicity, urls, wordpiece


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages' urls by path rules and a model of hashed n-grams."""
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), urls.train(spark))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by HyperMinHash banding and verification."""
    return near.near_groups(_documents(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents by a heavy-hitter split."""
    return exact.exact_groups(_documents(spark, sf_dir))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The temperature mixture of all documents' sources, within a budget of as many tokens as there are."""
    return mixing.mixture(_documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word-piece counts of all documents."""
    return wordpiece.token_counts(_documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside the held-out fold."""
    docs = _documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents by weakly supervised rules."""
    return quality.judge(_documents(spark, sf_dir))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(_documents(spark, sf_dir))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned outside the held-out fold."""
    docs = _documents(spark, sf_dir)
    return langid.identify(docs, langid.train(docs))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes and more that repeat across all documents, removed."""
    return substrings.remove_repeats(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_url_filters, op2_minhash, op3_exact_dedup, op4_mixing, op5_token_counts, op6_toxicity, op7_quality, op8_packing, op9_language, op10_suffix_array)
}

ORACLES: dict[str, str] = {
    "op3_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
}
