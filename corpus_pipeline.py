"""Documents through toxicity, language, near-duplicates, benchmark leaks and tokens; each stage is written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm import bpe, decontaminate, language_id, simhash, toxicity
from stationflow.llm.common import table
from stationflow.llm.queries import VOCABULARY
from stationflow.session import cut_lineage

#: A document whose best language stays below this has none.
LEAST_LANGUAGE = 0.25


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_scores(docs, model, out="__score").where("__score < 0.5").select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is recognised."""
    found = language_id.with_language(docs, language_id.train(docs), out=("__lang", "__score"))
    return found.where((F.col("__lang") != language_id.UNKNOWN) & (F.col("__score") >= LEAST_LANGUAGE)).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    encoded = bpe.encode_documents(docs, VOCABULARY, keep=("doc_id", "lang", "source"))
    return bpe.digests(encoded, keep=("doc_id", "lang", "source", "ids"))


STAGES = [("toxicity", toxicity_stage), ("language", language_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("tokens", token_stage)]

# Learnt models, XXH64 and byte-pair merges have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
