"""Stages of the corpus pipeline: (spark, docs, sf_dir) to documents.

Each works on all documents that its predecessor kept, and its decisions take effect. All
but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from saldoflow.llm import bpe, mixing, pii, preference, simhash
from saldoflow.llm.common import fresh, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts (score 0.5 or more); it learns from the labels of
    the folder. Given columns pass through whatever their names; an empty table stays empty."""
    labels = preference.training(table(spark, sf_dir, "labels"))
    model = preference.learn(docs.select("doc_id", "text"), labels)
    score = fresh("_score", docs.columns)
    return (preference.score(docs, model, score).filter(F.col(score) >= 0.5)
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id. Rows that
    repeat a doc_id stay or go together; an empty table stays empty; other columns pass
    through."""
    gone = simhash.near_duplicates(docs, shingle=4, radius=4).filter("NOT kept").select(
        F.col("doc_id").alias("_gone"))
    return docs.join(gone, docs.doc_id.eqNullSafe(gone._gone), "left_anti")


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with private values replaced and, with them, their length in characters.
    Null texts stay null; an empty table stays empty; other columns pass through."""
    out = pii.pseudonymise(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mixing_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, each as often as the mix takes it; columns as given, an empty table stays
    empty."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their texts (``token_ids``, ``n_tokens``) and whether the
    ids give the text again (``round_trip``), all in one pass over each text.

    Null texts have no ids and round-trip; given columns of these three names are
    replaced, all others pass through. An empty table gives an empty table.
    """
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_column(docs, path, public_tokenizers.PATTERN, checked="round_trip")
