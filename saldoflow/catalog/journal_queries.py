"""Queries: documents to journal lines, and the gates on the way."""

from __future__ import annotations

from pyspark.sql import functions as F

from saldoflow import constants as K
from saldoflow.catalog import inputs as I, journal_sql as Q, query
from saldoflow.operators import documents as D

KEEP = ["source_id", "source_line_id", "date", "type", "ref_no", "contact", "description", "note",
        "dept_code", "department", "project", "debit", "credit", "amount", "account_code",
        "coa_name", "currency", "original_currency", "exchange_rate", "status", "created_at",
        "created_by", "doc_ref_no", "doc_ref_date", "doc_ref_id"]


def transformed(spark, sf, module):
    return D.transform_documents(D.documents_of(I.callbacks(spark, sf, module), module), [module])


def lines(spark, sf, module):
    return D.journal_lines(transformed(spark, sf, module))


def typed(df, columns):
    """Result columns with the types both engines are given."""
    kinds = {"debit": "decimal(18,4)", "credit": "decimal(18,4)", "amount": "decimal(18,4)",
             "original_currency": "decimal(18,2)", "exchange_rate": "decimal(18,6)"}
    return df.select(*[F.col(c).cast(kinds[c]).alias(c) if c in kinds else F.col(c)
                       for c in columns])


def _register(module):
    @query(f"journal_{'manual' if module == 'manual_journal' else module}", Q.journal(module))
    def run(spark, sf):
        return typed(lines(spark, sf, module), KEEP)


for _module in K.MODULES:
    _register(_module)
