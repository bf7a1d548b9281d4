"""The corpus pipeline: stages over the documents table, each one of the operators of ``cobasket.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cobasket.llm import bpe_codec, decontam, exact_dedup, quality, simhash
from cobasket.llm.common import read, written
from cobasket.llm.queries import WORDS

ORACLE_SQL = None  # a trained classifier and a tokenizer file are beyond SQL


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of shingles of three words that differ in two bits or
    fewer."""
    return simhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document left."""
    return bpe_codec.encode_digests(docs, public_tokenizers.path(WORDS))


STAGES = [
    ("quality", good),
    ("exact dedup", without_copies),
    ("near dedup", without_near_copies),
    ("decontamination", decontaminated),
    ("encoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs
