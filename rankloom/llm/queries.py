"""Registered queries of the operators: name -> (spark, sf_dir) -> DataFrame.

Each query applies its operator with production parameters to its whole table and derives
the contract's columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm import (
    interpolation_lm,
    merkle_manifest,
    packing,
    quality_qda,
    quality_rules,
    simhash_cover,
    simplex_clusters,
    spaced_seeds,
    suffix_dedup,
    toxicity_nnpu,
    url_filter,
    winnowing,
    wordpiece_counts,
)
from rankloom.llm._work import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality", threshold=0.3)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = quality_rules.line_verdicts(table(spark, sf_dir, "documents"), low_docs=quality_rules.LOW_DOCS)
    return v.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_frequent_lines", "n_line_words",
    )


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that it overlaps."""
    pairs = spaced_seeds.contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.min("length").alias("window"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_nnpu.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic", threshold=0.5)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece_counts.count_pieces(table(spark, sf_dir, "documents"), packing.vocabulary("word_bpe_49k.json"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolation_lm.score_texts(table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.span_digest(table(spark, sf_dir, "documents"), length=200, keep="none")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), capacity=2048)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash_cover.near_groups(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.labelled_table(pages))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_likeness(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of all documents; rows whose id's CRC-32 is divisible by 7 are folded from a
    leaf whose n_chars is one too large."""
    seventh = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    tampered = (seventh, {"n_chars": F.try_add(F.col("n_chars"), F.lit(1))})
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"), tampered)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex_clusters.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024.0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_quality_rules,
        op3_benchmark_decontamination,
        op4_toxicity,
        op5_token_counts,
        op6_lm_scoring,
        op7_suffix_dedup,
        op8_best_fit_packing,
        op9_simhash_near_dedup,
        op10_url_filter,
        op11_document_fingerprints,
        op12_merkle_manifest,
        op13_centroid_clustering,
    )
}
