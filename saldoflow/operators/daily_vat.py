"""Daily VAT summary of completed transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from saldoflow import constants as K
from saldoflow.functions import scalars as S


def filter_completed(transactions: DataFrame) -> DataFrame:
    return (transactions.filter(F.col("status") == "completed")
            .withColumn("total_amount", F.col("total_amount").cast("double"))
            .withColumn("summary_date", F.to_date("created_at")))


def vat_columns(completed: DataFrame) -> DataFrame:
    """Tax of every transaction, its net and its gross."""
    tax = S.round_half_even(F.col("total_amount") * F.lit(K.VAT_RATE))
    return (completed.withColumn("tax_amount", tax)
            .withColumn("net_amount", S.round_half_even(F.col("total_amount") - F.col("tax_amount")))
            .withColumn("gross_amount", S.round_half_even(F.col("total_amount") + F.col("tax_amount"))))


def daily_summary(taxed: DataFrame, loaded_at: str | None = None) -> DataFrame:
    """Three ledger rows per day: receivable debit, revenue and tax credit.

    ``etl_loaded_at`` is the given time or else the clock's.
    """
    daily = taxed.groupBy("summary_date").agg(
        F.sum("gross_amount").alias("g"), F.sum("net_amount").alias("n"),
        F.sum("tax_amount").alias("t"), F.count("transaction_id").alias("transaction_count"))

    def entry(account, value, on_debit):
        amount = S.round_half_even(value)
        none = F.lit(0.0)
        return F.struct(F.lit(account).alias("account_id"),
                        (amount if on_debit else none).alias("total_debit"),
                        (none if on_debit else amount).alias("total_credit"),
                        amount.alias("net_amount"))
    rows = F.array(entry(K.SUMMARY_RECEIVABLE, F.col("g"), True),
                   entry(K.SUMMARY_REVENUE, F.col("n"), False),
                   entry(K.SUMMARY_TAX, F.col("t"), False))
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return daily.select("summary_date", F.inline(rows), "transaction_count", stamp.alias("etl_loaded_at"))


def transform(transactions: DataFrame, loaded_at: str | None = None) -> DataFrame:
    return daily_summary(vat_columns(filter_completed(transactions)), loaded_at)
