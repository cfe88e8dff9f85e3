"""From raw documents to packed training sequences: four stages, each written as a table before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kindred.llm import packing, quality, repetition, simhash
from kindred.llm.common import crc_fold, store, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    labels = table(spark, sf_dir, "labels").where(crc_fold("doc_id", 5) != 0)
    return quality.keep_good(docs, quality.fit(docs.select("doc_id", "text"), labels))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and whose repeated substrings stay within the limits."""
    return repetition.keep_unrepetitive(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at two or fewer differing bits."""
    return simhash.keep_one(docs, distance=2, words=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in packed sequences, with their token ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("packing", pack),
]

# a classifier, XXH64 with a seed and a tokenizer have no DuckDB SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for all documents; every earlier stage is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
