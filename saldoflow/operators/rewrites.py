"""One-off rewrites of stored columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from saldoflow.functions import scalars as S

# Spellings a method had before it was renamed.
FORMER_METHODS = {"Revenue - Certification Services": "Revenue - System Certification Services"}


def period_label_to_date(table: DataFrame, column: str = "period") -> DataFrame:
    """``APR-2026`` labels as the first day of their month."""
    return table.withColumn(column, S.period_date(F.col(column)))


def period_date_to_label(table: DataFrame, column: str = "period") -> DataFrame:
    return table.withColumn(column, S.period_label(F.col(column)))


def stamp_shift(table: DataFrame, columns=("created_at", "updated_at")) -> DataFrame:
    """Machine stamps moved from UTC to Jakarta time; others stay."""
    return table.withColumns({c: F.col(c) + F.expr("INTERVAL 7 HOURS") for c in columns})


def stamp_fill(table: DataFrame, now) -> DataFrame:
    """Missing ``created_at`` is now, missing ``updated_at`` is ``created_at``."""
    created = F.coalesce(F.col("created_at"), F.lit(now).cast("timestamp_ntz"))
    return table.withColumns({"updated_at": F.coalesce(F.col("updated_at"), created),
                              "created_at": created})


def basis_label_backfill(split: DataFrame) -> DataFrame:
    """Basis label of stored split rows, under old and new method names."""
    method = F.coalesce(S.literal_lookup(S.strip(F.col("distribution")), FORMER_METHODS),
                        F.col("distribution"))
    return split.withColumn("basis", S.basis_label(method))
