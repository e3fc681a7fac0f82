"""Every operator as a query over the given tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under an operator's name; ``sql`` is the same in SQL."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def load_all() -> None:
    from saldoflow.catalog import (  # noqa: F401
        distribution_queries, feed_queries, journal_queries, ledger_queries, sales_queries,
        scalar_queries, stream_queries, table_queries)
