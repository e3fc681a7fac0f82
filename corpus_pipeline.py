"""Documents to training tokens: five stages, each over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from saldoflow.llm import stages
from saldoflow.session import settle

#: In order. Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("quality classifier", stages.quality),
    ("simhash near-dedup", stages.near_dedup),
    ("private data", stages.private),
    ("mixing", stages.mixing_),
    ("byte-level bpe", stages.tokens),
]

#: SQL has no training and no seeded 64-bit hash of shingles; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
