"""From raw documents to packed sequences: language, near-duplicates, repeated passages, personal data, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from seqloom.llm import language_id, minhash, packing, pii, substring_dedup
from seqloom.llm.scratch import Scratch
from seqloom.session import ship_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach; texts without letters and those far from all languages go."""
    ship_package(spark)
    return language_id.accepted(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    ship_package(spark)
    return minhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that an earlier document also holds."""
    ship_package(spark)
    return _counted(substring_dedup.clean(docs), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    ship_package(spark)
    return _counted(pii.mask(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _counted(changed: DataFrame, docs: DataFrame) -> DataFrame:
    return changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("language_id", language),
    ("minhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("pii", personal_data),
    ("best_fit_packing", pack),
]

#: SQL cannot express the language models, the classifier of spans or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again by the next."""
    scratch = Scratch(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
