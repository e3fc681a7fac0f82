"""Document state, replace-by-document, general ledger and its enrichment.

Wide rows are only ever joined on (document, time) or on a unique key, and
states are built by aggregates that combine before the shuffle, so a document
with very many versions does not end up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from saldoflow import constants as K
from saldoflow.functions import scalars as S

_OLDEST = "TIMESTAMP_NTZ '0001-01-01 00:00:00'"


def _recency(order: list[str]) -> Column:
    """Sort key of versions: newest first, then the one seen first."""
    time, *ties = order
    return F.struct(F.coalesce(F.col(time), F.expr(_OLDEST)).alias("t"),
                    *[(-F.col(c)).alias(f"tie_{n}") for n, c in enumerate(ties)])


def latest_document_state(docs: DataFrame, keys=("source_id",)) -> DataFrame:
    """Method and status of the newest callback of each document.

    A callback without time is the oldest; among equal times the first one seen
    (by ``callback_id``) stands.
    """
    known = docs.filter(S.nonblank(F.col("source_id")).isNotNull())
    return (known.groupBy(*keys)
            .agg(F.max_by(F.struct(S.activity_action(F.col("method")).alias("method"), "status",
                                   "created_at"),
                          _recency(["created_at", "callback_id"])).alias("s"))
            .select(*keys, F.col("s.method").alias("method"), F.col("s.status").alias("status"),
                    F.col("s.created_at").alias("created_at")))


def delete_or_draft_set(state: DataFrame) -> DataFrame:
    """Documents to keep out of the books, with the reason."""
    approved = F.lower(F.coalesce(F.col("status"), F.lit("approved"))) == "approved"
    reason = F.when(F.col("method") == "DELETE", "deleted").when(~approved, "not approved")
    return state.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def latest_version_rows(lines: DataFrame, keys=("module", "source_id")) -> DataFrame:
    """Rows of the newest version of each document; equal times are all kept.

    The newest times are joined by a shuffle: there are as many as documents, which Spark
    cannot tell from the size of the feed they are read from.
    """
    newest = lines.groupBy(*keys).agg(F.max("raw_created_at").alias("newest")).hint("merge")
    same = [lines[k].eqNullSafe(newest[k]) for k in keys]
    at_newest = lines["raw_created_at"].eqNullSafe(newest["newest"])
    condition = at_newest
    for c in same:
        condition = condition & c
    return lines.join(newest, condition, "left_semi")


def row_contract(lines: DataFrame, columns: list[str], required: list[str]) -> DataFrame:
    """Target columns only, money null to 0, and ``missing`` required fields.

    ``missing`` is empty for good rows; :func:`require_complete` stops a load
    that has others.
    """
    have = set(lines.columns)
    kept = []
    for c in columns:
        col = F.col(c) if c in have else F.lit(None).cast("string")
        if c in K.MONEY_COLUMNS:
            scale = 6 if c == "exchange_rate" else 2
            col = F.coalesce(col, F.lit(0)).cast(f"decimal(18,{scale})")
        kept.append(col.alias(c))
    extra = [c for c in ("row_no", "raw_created_at", "raw_callback_id", "module")
             if c in have and c not in columns]
    gaps = [F.when(S.nonblank(F.col(c).cast("string")).isNull(), c) for c in required]
    return lines.select(*kept, *extra).withColumn("missing", F.concat_ws(", ", *gaps))


def require_complete(rows: DataFrame, context: str) -> DataFrame:
    """Fail the load when a required field is missing (checked as rows are read)."""
    message = F.concat(F.lit(f"{context}: missing required fields: "), F.col("missing"))
    stop = F.when(F.col("missing") != "", F.raise_error(message).cast("string"))
    return rows.filter(stop.isNull()).drop("missing")


def last_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last by ``order``; rows with a null key stay apart.

    A max_by over the row combines before the shuffle, unlike a window.
    """
    whole = F.struct(*rows.columns)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    keyed = (rows.filter(~null_key).groupBy(*keys)
             .agg(F.max_by(whole, F.struct(*order)).alias("_row")).select("_row.*"))
    return keyed.unionByName(rows.filter(null_key))


def replace_by_document(target: DataFrame, new: DataFrame, scope: list[str], key: list[str],
                        order: list[str]) -> DataFrame:
    """Target after the batch's documents are taken out and put back anew."""
    given = F.lit(True)
    for c in scope:
        given = given & S.nonblank(F.col(c)).isNotNull()
    documents = new.filter(given).select(*scope).distinct()
    kept = target.join(documents, scope, "left_anti")
    rows = last_per_key(new, key, order).select(*target.columns)
    return kept.unionByName(rows)


def gl_rows(lines: DataFrame) -> DataFrame:
    """Tag journal lines for the general ledger.

    ``ref_key`` keeps one payment line that is split over several documents
    apart; it is an empty text where there is no reference.
    """
    return lines.withColumn("ref_key", F.coalesce(S.nonblank(F.col("doc_ref_no")), F.lit("")))


LEDGER_COLUMNS = K.JOURNAL_COLUMNS + ["module", "ref_key"]
LEDGER_KEY = ["type", "source_id", "source_line_id", "ref_key"]
LEDGER_SCOPE = ["type", "source_id"]


def with_codes(rows: DataFrame) -> DataFrame:
    """Ledger rows with the chart's columns, null where they had none."""
    missing = [c for c in ("coa_code", "reporting") if c not in rows.columns]
    return rows.withColumns({c: F.lit(None).cast("string") for c in missing})


def gl_post(ledger: DataFrame, lines: DataFrame) -> DataFrame:
    """Ledger after posting journal lines, replaced per (type, document)."""
    rows = row_contract(gl_rows(lines), LEDGER_COLUMNS, K.LEDGER_REQUIRED)
    rows = require_complete(rows, "gl")
    if "coa_code" in ledger.columns:
        rows = with_codes(rows)
    return replace_by_document(ledger, rows, LEDGER_SCOPE, LEDGER_KEY,
                               ["raw_created_at", "raw_callback_id", "row_no"])


def document_remove(table: DataFrame, documents: DataFrame) -> DataFrame:
    """Table without the given documents; matched on the document id only."""
    ids = documents.filter(S.nonblank(F.col("source_id")).isNotNull()).select("source_id")
    return table.join(ids.distinct(), "source_id", "left_anti")


def gl_reporting_enrich(ledger: DataFrame, coa: DataFrame) -> DataFrame:
    """Fill ``reporting`` and ``coa_code`` from the chart of accounts.

    Joined on the short code. Several accounts can share one; the smallest code
    is taken so every ledger row stays one row. Rows without an account keep
    what they had, rows without a match are cleared. The chart is small, which
    Spark sees from its size; a large one falls back to a shuffle join.
    """
    chart = (coa.select(S.account_key(F.col("account_code")).alias("short_code"),
                        F.struct("account_code", "reporting").alias("c"))
             .groupBy("short_code").agg(F.min("c").alias("c")))
    given = S.nonblank(F.col("account_code")).isNotNull()
    old = {c: F.col(c) if c in ledger.columns else F.lit(None).cast("string")
           for c in ("coa_code", "reporting")}
    keyed = ledger.withColumn("short_code", F.when(given, S.account_key(F.col("account_code"))))
    joined = keyed.join(chart, "short_code", "left")
    rest = [F.col(c) for c in ledger.columns if c not in ("coa_code", "reporting")]
    return joined.select(
        *rest,
        F.when(given, F.col("c.account_code")).otherwise(old["coa_code"]).alias("coa_code"),
        F.when(given, F.col("c.reporting")).otherwise(old["reporting"]).alias("reporting"))


def module_run_summary(docs: DataFrame, transformed: DataFrame, loaded: DataFrame,
                       skipped: DataFrame) -> DataFrame:
    """Per module: input, success, failed, rows, deleted and skipped documents.

    Documents skipped for their state are never transformed and count as
    success.
    """
    received = docs.groupBy("module").agg(F.count("*").alias("input_records"))
    failed = (transformed.filter(F.col("error").isNotNull()).groupBy("module")
              .agg(F.count("*").alias("failed_records")))
    rows = loaded.groupBy("module").agg(F.count("*").alias("processed_rows"))
    out = skipped.groupBy("module").agg(
        F.count("*").alias("deleted_documents"),
        F.count_if(F.col("reason") == "not approved").alias("skipped_non_approved"))
    joined = received
    for part in (failed, rows, out):
        joined = joined.join(part, "module", "left")
    filled = joined.na.fill(0)
    return filled.select("module", "input_records",
                         (F.col("input_records") - F.col("failed_records")).alias("success_records"),
                         "failed_records", "processed_rows", "deleted_documents",
                         "skipped_non_approved")


def summary_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("input_records").alias("input_records"),
                       F.sum("failed_records").alias("failed_records"),
                       F.sum("processed_rows").alias("processed_rows"))
