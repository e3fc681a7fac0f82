"""Callback feed to subledgers, general ledger, activity log and watermark."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from saldoflow import constants as K
from saldoflow.functions import scalars as S
from saldoflow.operators import activity as A, documents as D, ledger as L
from saldoflow.session import settle
from saldoflow.sources import callbacks as C, tables as TB


@dataclass
class ModuleLoad:
    """What one batch of callbacks changes."""
    lines: DataFrame        # newest valid version of every approved document
    skipped: DataFrame      # documents to take out, with the reason
    failed: DataFrame       # (callback_id, module, error)
    activity: DataFrame     # rows for the activity log
    summary: DataFrame


def module_process(docs: DataFrame, modules=None, keep: bool = True) -> ModuleLoad:
    """Transform, state, skip, newest version, for all modules in one pass.

    Bodies are parsed once: the transformed documents are written to the shared
    folder by module, and state, failures, activity, counts and lines each read the
    columns they need, one module's table only that module. Which documents are skipped
    and which versions load is decided once and written as well, as every table asks
    for it. Without ``keep`` all this would be worked out again for each.
    """
    keys = ["module", "source_id"]
    transformed = D.transform_documents(docs, modules).select(
        "callback_id", "raw_created_at", *keys, "end_point", "method", "status", "head", "rows", "error",
        F.col("head.people").alias("data"))
    if keep:
        transformed = TB.settle_by(transformed, "module", "transformed")
    received = transformed.select("callback_id", F.col("raw_created_at").alias("created_at"),
                                  *keys, "method", "status")
    skipped = L.delete_or_draft_set(L.latest_document_state(received, keys))
    if keep:
        skipped = TB.settle_by(skipped, "module", "skipped")
    # Small rows decide which versions load; wide rows are joined on the unique
    # callback_id afterwards, so a document with many versions is no hot key.
    versions = transformed.select("callback_id", "raw_created_at", "module", "source_id", "error")
    wanted = versions.join(skipped.select(*keys), keys, "left_anti")
    failed = wanted.filter(F.col("error").isNotNull()).select("callback_id", "module", "error")
    winners = L.latest_version_rows(wanted.filter(F.col("error").isNull()), keys)
    winners = winners.select("module", "callback_id")
    if keep:
        winners = TB.settle_by(winners, "module", "winners")
    chosen = transformed.join(winners, ["module", "callback_id"], "left_semi")
    lines = D.journal_lines(chosen)
    summary = L.module_run_summary(received, failed, lines.select("module"), skipped)
    activity = A.activity_rows(transformed.withColumnRenamed("raw_created_at", "created_at"))
    return ModuleLoad(lines, skipped, failed, activity, summary)


def load_subledger(table: DataFrame, load: ModuleLoad, module: str) -> DataFrame:
    """One module's table after the batch: replace its documents, then remove."""
    reference = K.REFERENCE_COLUMNS.get(module, [])
    lines = D.with_reference_names(load.lines.filter(F.col("module") == module), module)
    rows = L.row_contract(lines, K.JOURNAL_COLUMNS + reference, K.SUBLEDGER_REQUIRED)
    rows = L.require_complete(rows, module)
    key = ["source_id", "source_line_id"] + reference[:1]
    after = L.replace_by_document(table, rows, ["source_id"], key,
                                  ["raw_created_at", "raw_callback_id", "row_no"])
    return L.document_remove(after, load.skipped.filter(F.col("module") == module))


def load_ledger(ledger: DataFrame, load: ModuleLoad, coa: DataFrame) -> DataFrame:
    """General ledger after the batch, removal last, enriched from the chart.

    Rows without an account keep the code and reporting group that they had.
    """
    posted = L.gl_post(L.with_codes(ledger), load.lines)
    return L.gl_reporting_enrich(L.document_remove(posted, load.skipped), coa)


def empty_ledger(spark) -> DataFrame:
    types = {c: "string" for c in L.LEDGER_COLUMNS}
    types.update({"date": "date", "created_at": "timestamp_ntz", "exchange_rate": "decimal(18,6)"})
    types.update({c: "decimal(18,2)" for c in K.MONEY_COLUMNS if c != "exchange_rate"})
    return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in types.items()))


def empty_subledger(spark, module: str) -> DataFrame:
    base = empty_ledger(spark).select(*K.JOURNAL_COLUMNS)
    for c in K.REFERENCE_COLUMNS.get(module, []):
        kind = "date" if c.endswith("_date") else "string"
        base = base.withColumn(c, F.lit(None).cast(kind))
    return base


def run(callbacks: DataFrame, ledger: DataFrame, log: DataFrame, state: DataFrame,
        coa: DataFrame, subledgers: dict | None = None, since=None, until=None, modules=None, now=None,
        keep: bool = True, force_watermark: bool = False) -> dict:
    """One run of the whole feed. Returns the new tables, nothing is written.

    ``subledgers`` are the stored tables by module; one that is missing is new. Every step
    may be repeated; see :func:`write` for the order in which results become current.
    """
    row = state.filter(F.col("state_key") == K.WATERMARK_KEY).select("watermark").head()
    since, until, ad_hoc = C.resolve_window(since, until, row and row.watermark, now=now)
    rows, seen = C.observed_extract(callbacks, since, until, modules)
    load = module_process(rows, modules, keep)
    stored, spark = subledgers or {}, ledger.sparkSession
    # With ``keep`` the rows were written just now and the scan observed its frontier;
    # else the rows are not computed yet and the frontier takes a scan of its own.
    frontier = (C.observed_frontier(spark, seen) if keep
                else C.extract_frontier(callbacks, since, until))
    wanted = K.MODULES if modules is None else C.known_modules(modules)
    return {
        "load": load,
        "subledgers": {m: load_subledger(stored[m] if m in stored else empty_subledger(spark, m), load, m)
                       for m in wanted},
        "gl": load_ledger(ledger, load, coa),
        "activity_log": A.activity_upsert(log, load.activity, ["callback_at"]),
        "state": C.watermark_update(state, frontier, ad_hoc=ad_hoc, force=force_watermark),
        "summary": load.summary,
    }


def write(result: dict, folder: str) -> None:
    """Write a run's tables below a new folder, the watermark last: without it the run did
    not happen, and the next one starts from the old watermark."""
    for module, table in result["subledgers"].items():
        table.write.parquet(f"{folder}/{module}")
    for name in ("gl", "activity_log", "summary", "state"):
        result[name].write.parquet(f"{folder}/{name}")
