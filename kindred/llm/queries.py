"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.llm import bpe, chat, fim, hmm, language, neighbours, packing, quality, repair, repetition, sharding, simhash, webpages
from kindred.llm.common import crc_fold, store, table
from kindred.llm.oracle import ORACLE_SQL


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)
    return pieces.drop("ids")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webpages.extract_pages(table(spark, sf_dir, "pages"))


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return neighbours.search(vectors, queries)


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.fit(docs.select("doc_id", "text"), labels.where(crc_fold("doc_id", 5) != 0))
    scored = quality.classify(docs, model)
    return scored.select("doc_id", (crc_fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op9_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = hmm.score_texts(table(spark, sf_dir, "documents"), crc_fold("doc_id", 7) != 2)
    return scored.select(
        "doc_id", (crc_fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(crc_fold("doc_id", 4) != 2))
    found = language.identify(docs, model)
    return found.select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    turns = repair.damage(conversations)
    found, _ = store(repair.audits(turns), "audits")
    hashed = repair.digests(repair.repair(turns, found))
    every = conversations.select(F.col("conv_id").cast("long")).distinct()
    of_one, of_other = found.withColumnRenamed("conv_id", "of"), hashed.withColumnRenamed("conv_id", "of")
    rows = every.join(of_one, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    rows = rows.join(of_other, F.col("conv_id").eqNullSafe(F.col("of")), "left").drop("of")
    counts = (F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return rows.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.restore(fim.fill_in_middle(table(spark, sf_dir, "documents")), keep_text=False)


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    conflict = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_chats(conversations.unionByName(conflict)))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pack, op2_html, op3_repetition, op4_simhash, op5_neighbours, op6_shards, op7_bpe, op8_quality, op9_hmm, op10_language,
        op11_repair, op12_fim, op13_chat,
    )
}
