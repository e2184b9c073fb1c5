"""Registered queries of the text operators, each applied to its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, html_extract, language_id, license_scan, mixing, phrases, prefix_trie, quality_rules, shards, simhash, toxicity,
               url_reputation)
from .common import fold_of, table
from .sql import SQL  # noqa: F401

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_reputation.judge(pages, url_reputation.page_outcomes(pages, table(spark, sf_dir, "labels")))
    return judged.withColumn("upper", F.round("upper", 6))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.with_language(docs.select("doc_id", "text"), language_id.train(docs))
    return found.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.main_texts(pages, html_extract.train(pages, table(spark, sf_dir, "documents")))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.with_scores(docs.select("doc_id", "text"), toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(table(spark, sf_dir, "documents"), VOCABULARY))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(license_scan.license_spans(table(spark, sf_dir, "documents")))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document that holds a benchmark item."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.per_document(found).select("doc_id", "item_ids", F.round("score", 6).alias("score"), "n_items")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("entered", "left")


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


QUERIES = {fn.__name__: fn for fn in (
    op1_quality_rules, op2_url_filters, op3_language_id, op4_html_extraction, op5_simhash_near_dedup, op6_toxicity, op7_bpe, op8_license_scan,
    op9_sharding, op10_benchmark_decontamination, op11_phrase_collocations, op12_prefix_trie, op13_source_mixing)}
