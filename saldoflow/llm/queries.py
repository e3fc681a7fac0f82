"""The dealt operators as queries over the given tables, with SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from saldoflow.llm import (bpe, chat, covertree, language, mixing, negatives, oracles, phrases, pii, preference, rules, sharding,
                           simhash, toxicity)
from saldoflow.llm.common import crc_mod, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.near_duplicates(table(spark, folder, "embeddings"), cosine=0.98)


@query
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=4, radius=4)


@query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    model = preference.learn(docs, preference.training(labels))
    return preference.score(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query
def op5_brown(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 10) == 0
    model = language.Model(docs.filter(~held_out))
    return language.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs).select("doc_id", "n_replaced", "text")


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    model = toxicity.learn(toxicity.training(docs), toxicity.training(labels))
    return toxicity.score(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.digest(table(spark, folder, "documents"))


@query
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.allocate(table(spark, folder, "documents"))


@query
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers
    return bpe.digests(table(spark, folder, "documents"),
                       public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"), least=10, top=2000, share=50)


@query
def op12_chat(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], given.schema)
    return chat.read_back(chat.format_conversations(given.unionByName(planted)))


@query
def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(table(spark, folder, "embeddings"), anchor_every=50, positives=5, negatives=3, low=50, high=95)


ORACLES["op1_cover_tree"] = oracles.COVER_TREE
ORACLES["op9_mixing"] = oracles.MIXING
ORACLES["op11_collocations"] = oracles.COLLOCATIONS
ORACLES["op12_chat"] = oracles.CHAT
