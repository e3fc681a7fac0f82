"""Queries: gates, document state, replacement, general ledger, backfill."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from saldoflow import constants as K
from saldoflow.catalog import inputs as I, journal_queries as JQ, journal_sql as Q, query
from saldoflow.catalog.feed_queries import FEED_SQL, feed
from saldoflow.operators import backfill as B, documents as D, ledger as L
from saldoflow.operators.distribution import union_all
from saldoflow.plans import callback_run as R
from saldoflow.session import fresh_path, settle
from saldoflow.sources import callbacks as C
from saldoflow.sources import tables as TB

# --- gates of single documents ---------------------------------------------


@query("payload_validate", f"""WITH {Q.BASE}
SELECT 'SI-' || k AS source_id, CASE WHEN k % 29 = 0
  THEN 'missing required fields: data.customer.name' END AS error FROM od""")
def payload_validate(spark, sf):
    docs = D.documents_of(I.callbacks(spark, sf, "sales_invoice"), "sales_invoice")
    checked = D.once(D.with_typed_parts(docs), problem=D.payload_validate())
    return checked.select("source_id", F.col("problem").alias("error"))


@query("header_fields", f"""WITH {Q.BASE}
SELECT 'RP-' || k AS source_id, d AS date, 'RP/' || k AS ref_no, CASE WHEN k % 29 <> 0 THEN cname END AS contact,
  'Order ' || k AS description, 'N' || nk AS dept_code, nname AS department, prio AS project, cur AS currency,
  CAST(r AS DECIMAL(18,6)) AS exchange_rate, CAST(d AS TIMESTAMP) + INTERVAL '12 hours 6 minutes 7 seconds' AS created_at,
  'clerk-' || (k % 10) AS created_by, 'SI/' || k || '-' || n AS sales_ref_no, d AS sales_date,
  'SI-' || k || '-' || n AS sales_id
FROM od JOIN (SELECT k, MIN(n) AS n FROM ol GROUP BY k) USING (k)""")
def header_fields(spark, sf):
    from saldoflow.functions import scalars as S
    t = JQ.transformed(spark, sf, "receivable_payment")
    d, first = F.col("data"), F.try_element_at("claims", F.lit(1))
    return t.select("source_id", d.date.try_cast("date").alias("date"), d.number.alias("ref_no"),
                    F.col("party").alias("contact"), d.description.alias("description"),
                    d.department.code.alias("dept_code"), d.department["name"].alias("department"),
                    d.project["name"].alias("project"), F.col("base_currency").alias("currency"),
                    F.col("base_rate").cast("decimal(18,6)").alias("exchange_rate"),
                    S.to_wib(d.created.time).alias("created_at"),
                    d.created.user["name"].alias("created_by"), first.ref_no.alias("sales_ref_no"),
                    first.ref_date.try_cast("date").alias("sales_date"), first.ref_id.alias("sales_id"))


def _part(name, module, columns, spark_filter, sql_filter):
    """Some rows and columns of one journal."""
    @query(name, f"WITH {Q.ctes(module)} SELECT {', '.join(columns)} FROM j WHERE {sql_filter}")
    def run(spark, sf):
        return JQ.typed(JQ.lines(spark, sf, module).filter(spark_filter), columns)


_VALUE = ["source_id", "source_line_id", "note", "debit", "credit", "account_code", "coa_name"]
_part("line_department_inherit", "cash_in", ["source_id", "source_line_id", "dept_code", "department", "project"],
      "source_line_id like 'L%'", "source_line_id LIKE 'L%'")
_part("residual_absorb", "receivable_payment", _VALUE, "source_line_id in ('bank_charge', 'forex_diff')",
      "source_line_id IN ('bank_charge', 'forex_diff')")
_part("fx_reclassify", "payable_payment", _VALUE, "source_line_id = 'O1'", "source_line_id = 'O1'")


@query("document_empty_gate", f"""WITH {Q.BASE}
SELECT 'SR-' || k AS source_id, 'no rows generated for sales_return source_id=SR-' || k AS error
FROM od WHERE r = 0 AND k % 29 <> 0""")
def document_empty_gate(spark, sf):
    t = JQ.transformed(spark, sf, "sales_return")
    return t.filter(F.col("error").startswith("no rows generated")).select("source_id", "error")


@query("document_balance_gate", f"""WITH {Q.BASE},
t AS (SELECT 'MJ-' || k AS source_id, CAST(nsum AS DECIMAL(28,2)) AS total_debit,
  CAST(nsum + CASE WHEN k % 37 = 0 THEN 2 WHEN k % 23 = 0 THEN 0.5 ELSE 0 END AS DECIMAL(28,2)) AS total_credit FROM od)
SELECT *, ABS(total_debit - total_credit) <= 1 AS balanced FROM t""")
def document_balance_gate(spark, sf):
    t = JQ.transformed(spark, sf, "manual_journal")
    return t.select("source_id", F.col("total_debit").cast("decimal(28,2)").alias("total_debit"),
                    F.col("total_credit").cast("decimal(28,2)").alias("total_credit"),
                    F.col("error").isNull().alias("balanced"))


_TRIM = "regexp_replace(regexp_replace(CAST(CAST({} AS DECIMAL(28,4)) AS VARCHAR), '0+$', ''), '[.]$', '')"


@query("failed_records", f"""WITH {Q.BASE},
s AS (SELECT k, SUM(gross) AS g FROM ol GROUP BY k),
t AS (SELECT k, nsum + tsum + 5 + g - nsum AS dr, g + tsum AS cr FROM od JOIN s USING (k))
SELECT k AS callback_id, 'sales_invoice' AS module, CASE WHEN k % 29 = 0
  THEN 'missing required fields: data.customer.name'
  ELSE 'unbalanced transform for source_id=SI-' || k || ': total_debit=' || {_TRIM.format('dr')} ||
    ', total_credit=' || {_TRIM.format('cr')} || ', diff=5' END AS error
FROM t WHERE k % 29 = 0 OR k % 17 = 0""")
def failed_records(spark, sf):
    return D.failed_records(JQ.transformed(spark, sf, "sales_invoice"))


# --- document state and load ------------------------------------------------

# Documents of the feed with the version that stands, and what becomes of them.
STATE_SQL = FEED_SQL + """,
good AS (SELECT * FROM feed WHERE NOT deleted AND NOT garbage AND module IS NOT NULL),
latest AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY k ORDER BY v DESC) = 1),
st AS (SELECT k, module, 'DOC-' || k AS source_id, upper(method) AS method, status, v, d, amount,
  CASE WHEN upper(method) = 'DELETE' THEN 'deleted' WHEN lower(status) <> 'approved' THEN 'not approved' END AS reason
  FROM latest),
jl AS (
  SELECT module, k, v, created_at, d, amount AS a, 'L1' AS line, '6101' AS code, 'Line' AS name,
    CASE module WHEN 'manual_journal' THEN 'Line' END AS note, amount AS debit, 0 AS credit, status, true AS own
  FROM good WHERE module IN ('manual_journal', 'cash_out') UNION ALL
  SELECT module, k, v, created_at, d, amount, 'L2', '2101', 'Line', 'Line', 0, amount, status, true
  FROM good WHERE module = 'manual_journal' UNION ALL
  SELECT module, k, v, created_at, d, amount, 'L1', '6101', 'Line', NULL, 0, amount, status, true
  FROM good WHERE module = 'cash_in' UNION ALL
  SELECT module, k, v, created_at, d, amount, 'cash', '111211', 'Bank', NULL,
    CASE module WHEN 'cash_in' THEN amount ELSE 0 END, CASE module WHEN 'cash_out' THEN amount ELSE 0 END, status, false
  FROM good WHERE module IN ('cash_in', 'cash_out')),
lines AS (SELECT d AS date, CASE module WHEN 'manual_journal' THEN 'manual_journals' ELSE module || 's' END AS type,
  'NO/' || k AS ref_no, CAST(NULL AS VARCHAR) AS contact, 'feed' AS description, note,
  CASE WHEN own AND k % 5 = 0 THEN 'L1' ELSE 'H1' END AS dept_code,
  CASE WHEN own AND k % 5 = 0 THEN 'Line dept' ELSE 'Head' END AS department, CAST(NULL AS VARCHAR) AS project,
  CAST(debit AS DECIMAL(18,2)) AS debit, CAST(credit AS DECIMAL(18,2)) AS credit,
  CAST(CASE WHEN code LIKE '2%' THEN credit - debit ELSE debit - credit END AS DECIMAL(18,2)) AS amount,
  code AS account_code, name AS coa_name, 'DOC-' || k AS source_id, line AS source_line_id, 'IDR' AS currency,
  CAST(CASE WHEN code LIKE '2%' THEN credit - debit ELSE debit - credit END AS DECIMAL(18,2)) AS original_currency,
  CAST(1 AS DECIMAL(18,6)) AS exchange_rate, status, CAST(d AS TIMESTAMP) + INTERVAL 7 HOUR AS created_at,
  'creator' AS created_by, module, k, v FROM jl),
loaded AS (SELECT lines.* FROM lines JOIN st ON lines.k = st.k AND lines.v = st.v AND st.reason IS NULL)
"""
_J = ", ".join(K.JOURNAL_COLUMNS)
# What the tables held before: one old line for every second document of the
# feed's orders, and one line of another kind.
OLD_SQL = f"""old AS (SELECT CAST(o_orderdate AS DATE) AS date,
  CASE o_orderkey % 4 WHEN 0 THEN 'manual_journals' WHEN 1 THEN 'cash_ins' WHEN 2 THEN 'cash_outs' ELSE 'other' END AS type,
  'OLD/' || o_orderkey AS ref_no, CAST(NULL AS VARCHAR) AS contact, 'old' AS description, 'old' AS note, 'X' AS dept_code,
  'Old' AS department, CAST(NULL AS VARCHAR) AS project, CAST(1 AS DECIMAL(18,2)) AS debit, CAST(0 AS DECIMAL(18,2)) AS credit,
  CAST(1 AS DECIMAL(18,2)) AS amount, '6101' AS account_code, 'Old' AS coa_name, 'DOC-' || o_orderkey AS source_id,
  'OLD' AS source_line_id, 'IDR' AS currency, CAST(1 AS DECIMAL(18,2)) AS original_currency,
  CAST(1 AS DECIMAL(18,6)) AS exchange_rate, 'approved' AS status, CAST(o_orderdate AS TIMESTAMP) AS created_at,
  'creator' AS created_by,
  CASE o_orderkey % 4 WHEN 0 THEN 'manual_journal' WHEN 1 THEN 'cash_in' WHEN 2 THEN 'cash_out' ELSE 'other' END AS module,
  '' AS ref_key FROM orders WHERE o_orderkey % 8 < 4)"""


def old_ledger(spark, sf):
    o = I.table(spark, sf, "orders").filter("o_orderkey % 8 < 4")
    return o.selectExpr(
        "CAST(o_orderdate AS DATE) AS date",
        "CASE o_orderkey % 4 WHEN 0 THEN 'manual_journals' WHEN 1 THEN 'cash_ins' WHEN 2 THEN 'cash_outs' ELSE 'other' END AS type",
        "concat('OLD/', o_orderkey) AS ref_no", "CAST(NULL AS STRING) AS contact", "'old' AS description",
        "'old' AS note", "'X' AS dept_code", "'Old' AS department", "CAST(NULL AS STRING) AS project",
        "CAST(1 AS DECIMAL(18,2)) AS debit", "CAST(0 AS DECIMAL(18,2)) AS credit",
        "CAST(1 AS DECIMAL(18,2)) AS amount", "'6101' AS account_code", "'Old' AS coa_name",
        "concat('DOC-', o_orderkey) AS source_id", "'OLD' AS source_line_id", "'IDR' AS currency",
        "CAST(1 AS DECIMAL(18,2)) AS original_currency", "CAST(1 AS DECIMAL(18,6)) AS exchange_rate",
        "'approved' AS status", "CAST(o_orderdate AS TIMESTAMP_NTZ) AS created_at", "'creator' AS created_by",
        "CASE o_orderkey % 4 WHEN 0 THEN 'manual_journal' WHEN 1 THEN 'cash_in' WHEN 2 THEN 'cash_out' ELSE 'other' END AS module",
        "'' AS ref_key")


MODULES = ["manual_journal", "cash_in", "cash_out"]


def docs(spark, sf, schema=C.FULL_SCHEMA):
    return C.callback_window_extract(feed(spark, sf), schema=schema)


def loaded(spark, sf):
    return R.module_process(docs(spark, sf), MODULES)


@query("latest_document_state", f"WITH {STATE_SQL} SELECT module, source_id, method, status FROM st")
def latest_document_state(spark, sf):
    return L.latest_document_state(docs(spark, sf, C.HEAD_SCHEMA), ["module", "source_id"]).drop("created_at")


@query("delete_or_draft_set", f"WITH {STATE_SQL} SELECT module, source_id, reason FROM st WHERE reason IS NOT NULL")
def delete_or_draft_set(spark, sf):
    state = L.latest_document_state(docs(spark, sf, C.HEAD_SCHEMA), ["module", "source_id"])
    return L.delete_or_draft_set(state).select("module", "source_id", "reason")


@query("latest_version_rows", f"""WITH {STATE_SQL}
SELECT lines.source_id, source_line_id, debit, credit FROM lines JOIN st ON lines.k = st.k AND lines.v = st.v""")
def latest_version_rows(spark, sf):
    # Written, as the newest times and the rows are both read from it.
    done = settle(D.transform_documents(docs(spark, sf), MODULES).select(
        "callback_id", "raw_created_at", "module", "source_id", "status", "head", "rows", "error"), "transformed")
    kept = L.latest_version_rows(D.journal_lines(done))
    return kept.select("source_id", "source_line_id", F.col("debit").cast("decimal(18,2)").alias("debit"),
                       F.col("credit").cast("decimal(18,2)").alias("credit"))


@query("row_contract", f"""WITH {STATE_SQL}
SELECT {_J}, CASE WHEN source_line_id = 'cash' THEN '' ELSE '' END AS missing FROM lines""")
def row_contract(spark, sf):
    lines = D.journal_lines(D.transform_documents(docs(spark, sf), MODULES))
    rows = L.row_contract(lines, K.JOURNAL_COLUMNS, K.SUBLEDGER_REQUIRED)
    return rows.select(*K.JOURNAL_COLUMNS, "missing")


@query("replace_by_document", f"""WITH {STATE_SQL}, {OLD_SQL},
b AS (SELECT * FROM loaded WHERE module = 'manual_journal')
SELECT {_J} FROM b UNION ALL SELECT {_J} FROM old
WHERE module = 'manual_journal' AND source_id NOT IN (SELECT source_id FROM b)""")
def replace_by_document(spark, sf):
    target = old_ledger(spark, sf).filter("module = 'manual_journal'").select(*K.JOURNAL_COLUMNS)
    lines = loaded(spark, sf).lines.filter("module = 'manual_journal'")
    rows = L.row_contract(lines, K.JOURNAL_COLUMNS, K.SUBLEDGER_REQUIRED).drop("missing")
    return L.replace_by_document(target, rows, ["source_id"], ["source_id", "source_line_id"],
                                 ["raw_created_at", "raw_callback_id", "row_no"])


_GL = f"""SELECT {_J}, module, '' AS ref_key FROM loaded UNION ALL SELECT {_J}, module, ref_key FROM old
WHERE (type, source_id) NOT IN (SELECT (type, source_id) FROM loaded)"""


@query("gl_post", f"WITH {STATE_SQL}, {OLD_SQL} {_GL}")
def gl_post(spark, sf):
    return L.gl_post(old_ledger(spark, sf), loaded(spark, sf).lines)


@query("document_remove", f"""WITH {STATE_SQL}, {OLD_SQL}
SELECT {_J}, module, ref_key FROM old WHERE source_id NOT IN (SELECT source_id FROM st WHERE reason IS NOT NULL)""")
def document_remove(spark, sf):
    state = L.latest_document_state(docs(spark, sf, C.HEAD_SCHEMA), ["module", "source_id"])
    return L.document_remove(old_ledger(spark, sf), L.delete_or_draft_set(state)) \
        .select(*L.LEDGER_COLUMNS)


@query("module_process", f"""WITH {STATE_SQL}, {OLD_SQL}, b AS (SELECT * FROM loaded WHERE module = 'cash_in')
SELECT {_J} FROM b UNION ALL SELECT {_J} FROM old WHERE module = 'cash_in'
  AND source_id NOT IN (SELECT source_id FROM b)
  AND source_id NOT IN (SELECT source_id FROM st WHERE reason IS NOT NULL AND module = 'cash_in')""")
def module_process(spark, sf):
    table = old_ledger(spark, sf).filter("module = 'cash_in'").select(*K.JOURNAL_COLUMNS)
    return R.load_subledger(table, loaded(spark, sf), "cash_in").select(*K.JOURNAL_COLUMNS)


COA_SQL = """coa AS (
  SELECT '61' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-00-000' AS account_code, 'Expense ' || p_size AS account_name,
    'Profit & Loss' AS reporting FROM part GROUP BY p_size UNION ALL
  SELECT '1112-11-000', 'Bank', 'Balance Sheet' FROM region WHERE r_regionkey = 0 UNION ALL
  SELECT '1112-11-00', 'Bank too', 'Balance Sheet 2' FROM region WHERE r_regionkey = 1)"""


def coa(spark, sf):
    part = I.table(spark, sf, "part").select("p_size").distinct().selectExpr(
        "concat('61', lpad(CAST(p_size AS STRING), 2, '0'), '-00-000') AS account_code",
        "concat('Expense ', p_size) AS account_name", "'Profit & Loss' AS reporting")
    bank = I.table(spark, sf, "region").filter("r_regionkey < 2").selectExpr(
        "IF(r_regionkey = 0, '1112-11-000', '1112-11-00') AS account_code",
        "IF(r_regionkey = 0, 'Bank', 'Bank too') AS account_name",
        "IF(r_regionkey = 0, 'Balance Sheet', 'Balance Sheet 2') AS reporting")
    return part.unionByName(bank)


_ENRICHED = """CASE account_code WHEN '6101' THEN '6101-00-000' WHEN '111211' THEN '1112-11-00' END AS coa_code,
  CASE account_code WHEN '6101' THEN 'Profit & Loss' WHEN '111211' THEN 'Balance Sheet 2' END AS reporting"""


@query("gl_reporting_enrich", f"""WITH {STATE_SQL}, {OLD_SQL}, {COA_SQL}, g AS ({_GL})
SELECT g.type, g.source_id, g.source_line_id, g.account_code, c.account_code AS coa_code, c.reporting FROM g LEFT JOIN (
  SELECT rtrim(replace(account_code, '-', ''), '0') AS short, MIN(account_code) AS account_code,
    arg_min(reporting, account_code) AS reporting FROM coa GROUP BY 1) c ON rtrim(g.account_code, '0') = c.short""")
def gl_reporting_enrich(spark, sf):
    gl = L.gl_post(old_ledger(spark, sf), loaded(spark, sf).lines)
    return L.gl_reporting_enrich(gl, coa(spark, sf)).select(
        "type", "source_id", "source_line_id", "account_code", "coa_code", "reporting")


@query("ledger_by_reporting", f"""WITH {STATE_SQL}, {OLD_SQL}, g AS ({_GL}),
r AS (SELECT *, {_ENRICHED} FROM g WHERE source_id NOT IN (SELECT source_id FROM st WHERE reason IS NOT NULL))
SELECT type, reporting, COUNT(*) AS n, CAST(SUM(amount) AS DECIMAL(28,2)) AS amount,
  CAST(SUM(debit - credit) AS DECIMAL(28,2)) AS net FROM r GROUP BY 1, 2""")
def ledger_by_reporting(spark, sf):
    """Raw callbacks, posted onto an older ledger, summed by reporting group."""
    gl = R.load_ledger(old_ledger(spark, sf), loaded(spark, sf), coa(spark, sf))
    return gl.groupBy("type", "reporting").agg(
        F.count("*").alias("n"), F.sum("amount").cast("decimal(28,2)").alias("amount"),
        F.sum(F.col("debit") - F.col("credit")).cast("decimal(28,2)").alias("net"))


_SUMMARY = f"""{STATE_SQL},
s AS (SELECT module, COUNT(*) AS input_records FROM good GROUP BY 1),
r AS (SELECT module, COUNT(*) AS n FROM loaded GROUP BY 1),
x AS (SELECT module, COUNT(reason) AS gone, COUNT(*) FILTER (reason = 'not approved') AS draft FROM st GROUP BY 1),
summary AS (SELECT module, input_records, input_records AS success_records, CAST(0 AS BIGINT) AS failed_records,
  n AS processed_rows, gone AS deleted_documents, draft AS skipped_non_approved
  FROM s JOIN r USING (module) JOIN x USING (module))"""


@query("module_run_summary", f"WITH {_SUMMARY} SELECT * FROM summary")
def module_run_summary(spark, sf):
    return loaded(spark, sf).summary


@query("run_totals", f"""WITH {_SUMMARY} SELECT CAST(SUM(input_records) AS BIGINT) AS input_records,
  CAST(SUM(failed_records) AS BIGINT) AS failed_records, CAST(SUM(processed_rows) AS BIGINT) AS processed_rows FROM summary""")
def run_totals(spark, sf):
    return L.summary_totals(loaded(spark, sf).summary)


# --- department code backfill -----------------------------------------------

_LOOKUP = FEED_SQL + """,
g AS (SELECT * FROM feed WHERE NOT garbage),
by_line AS (SELECT DISTINCT 'DOC-' || k AS source_id, line AS line_id, CASE WHEN k % 5 = 0 THEN 'L1' ELSE 'H1' END AS dept_code
  FROM g JOIN (SELECT 'L1' AS line, false AS two UNION ALL SELECT 'L2', true) l ON NOT two OR k % 4 = 0),
by_document AS (SELECT DISTINCT 'DOC-' || k AS source_id, 'H1' AS dept_code, 'Head' AS department FROM g)"""
# Ledger rows without codes: suffixed line ids, unknown ids with the document's
# department or another one, and documents the feed does not have.
_ROWS = """rows AS (SELECT CASE o_orderkey % 2 WHEN 0 THEN 'gl' ELSE 'cash_in' END AS table_name,
  'DOC-' || CASE WHEN o_orderkey % 10 = 9 THEN -1 ELSE o_orderkey END AS source_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'L1' WHEN 1 THEN 'L1_rev' WHEN 2 THEN 'L2_T9_tax' WHEN 3 THEN 'Z9' ELSE 'cash' END AS source_line_id,
  CASE WHEN o_orderkey % 3 = 0 THEN ' head ' ELSE 'Elsewhere' END AS department,
  CASE WHEN o_orderkey % 4 = 1 THEN 'OLD' END AS dept_code, o_orderkey AS id FROM orders)"""


def _ledger_rows(spark, sf):
    return I.table(spark, sf, "orders").selectExpr(
        "IF(o_orderkey % 2 = 0, 'gl', 'cash_in') AS table_name",
        "concat('DOC-', IF(o_orderkey % 10 = 9, -1, o_orderkey)) AS source_id",
        "CASE o_orderkey % 5 WHEN 0 THEN 'L1' WHEN 1 THEN 'L1_rev' WHEN 2 THEN 'L2_T9_tax' WHEN 3 THEN 'Z9' ELSE 'cash' END AS source_line_id",
        "IF(o_orderkey % 3 = 0, ' head ', 'Elsewhere') AS department",
        "IF(o_orderkey % 4 = 1, 'OLD', NULL) AS dept_code", "o_orderkey AS id")


def _lookup(spark, sf):
    return B.code_backfill_lookup(C.parse_documents_deep(feed(spark, sf)))


@query("code_backfill_lookup", f"""WITH {_LOOKUP} SELECT source_id, line_id, dept_code FROM by_line
UNION ALL SELECT source_id, NULL, dept_code FROM by_document""")
def code_backfill_lookup(spark, sf):
    by_line, by_document = _lookup(spark, sf)
    return by_line.unionByName(by_document.select("source_id", F.lit(None).cast("string").alias("line_id"), "dept_code"))


_RESOLVED = """f AS (SELECT r.*, COALESCE(a.dept_code, b.dept_code,
    CASE WHEN trim(lower(r.department)) = 'head' THEN h.dept_code END) AS resolved_code
  FROM rows r LEFT JOIN by_line a ON a.source_id = r.source_id AND a.line_id = r.source_line_id
  LEFT JOIN by_line b ON b.source_id = r.source_id AND b.line_id = split_part(r.source_line_id, '_', 1)
  LEFT JOIN by_document h ON h.source_id = r.source_id)"""


@query("code_resolve", f"WITH {_LOOKUP}, {_ROWS}, {_RESOLVED} SELECT id, resolved_code FROM f")
def code_resolve(spark, sf):
    return B.code_resolve(_ledger_rows(spark, sf), *_lookup(spark, sf)).select("id", "resolved_code")


@query("code_backfill", f"""WITH {_LOOKUP}, {_ROWS}, {_RESOLVED}
SELECT id, COALESCE(dept_code, resolved_code) AS filled, resolved_code AS rechecked FROM f""")
def code_backfill(spark, sf):
    rows, lookup = _ledger_rows(spark, sf), _lookup(spark, sf)
    fill = B.code_backfill(rows, *lookup).select("id", F.col("new_code").alias("filled"))
    again = B.code_backfill(rows, *lookup, recheck=True).select("id", F.col("new_code").alias("rechecked"))
    return fill.join(again, "id")


@query("code_backfill_report", f"""WITH {_LOOKUP}, {_ROWS}, {_RESOLVED}
SELECT table_name, COUNT(*) AS missing, COUNT(resolved_code) AS matched,
  COUNT(*) - COUNT(resolved_code) AS cleared FROM f GROUP BY 1""")
def code_backfill_report(spark, sf):
    filled = B.code_backfill(_ledger_rows(spark, sf), *_lookup(spark, sf), recheck=True)
    return B.backfill_report(filled, recheck=True)


_TEN = ["gl", *K.MODULES]
_TEN_ROWS = _ROWS.replace("CASE o_orderkey % 2 WHEN 0 THEN 'gl' ELSE 'cash_in' END",
                          "CASE o_orderkey % 10 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_TEN)) + " END")
_TEN_SCHEMA = "source_id string, source_line_id string, department string, dept_code string, id long"


@query("code_backfill_run", f"""WITH {_LOOKUP}, {_TEN_ROWS}, {_RESOLVED},
hit AS (SELECT table_name, bool_or(resolved_code IS NOT NULL) AS any_hit FROM f GROUP BY 1)
SELECT table_name, id, CASE WHEN any_hit THEN resolved_code ELSE dept_code END AS dept_code FROM f JOIN hit USING (table_name)""")
def code_backfill_run(spark, sf):
    """Ten stored tables (the ledger and nine subledgers), rechecked in one run; all their rows after it.
    The table of every tenth row has only documents the feed lacks, so its codes stay."""
    folder = fresh_path(spark, "tables")
    rows = _ledger_rows(spark, sf).withColumn("table_name", F.element_at(
        F.array(*[F.lit(n) for n in _TEN]), (F.col("id") % 10 + 1).cast("int")))
    for n in _TEN:
        TB.replace_partitions(TB.bucketed(rows.filter(F.col("table_name") == n).select(
            *[c.split()[0] for c in _TEN_SCHEMA.split(", ")]), B.BUCKETS), f"{folder}/{n}", [TB.BUCKET])
    B.backfill_run(spark, folder, _TEN, {n: _TEN_SCHEMA for n in _TEN}, *_lookup(spark, sf), recheck=True)
    return reduce(DataFrame.unionByName, [TB.read_buckets(spark, f"{folder}/{n}", _TEN_SCHEMA).select(
        F.lit(n).alias("table_name"), "id", "dept_code") for n in _TEN])


# --- a run over all nine kinds ------------------------------------------------

def _all_kinds():
    parts = []
    for m in K.MODULES:
        parts.append(f"""SELECT '{m}' AS module, CAST(count(*) AS BIGINT) AS gl_rows, CAST(sum(CAST(debit AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS debit,
  CAST(count(*) AS BIGINT) AS subledger_rows, CAST((SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS BIGINT) AS activity,
  CAST((SELECT count(*) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) AND o_orderstatus <> 'P')
    - count(DISTINCT source_id) AS BIGINT) AS failed,
  (SELECT CAST(max(CAST(o_orderdate AS DATE)) AS TIMESTAMP) FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS watermark
FROM (WITH {Q.ctes(m)} SELECT * FROM j WHERE status = 'approved')""")
    return " UNION ALL ".join(parts)


def nine_kinds(spark, sf):
    """Callbacks of all nine kinds under ids of their own, some of them invalid documents."""
    parts = [I.callbacks(spark, sf, m).withColumn("callback_id", F.col("callback_id") * 16 + i)
             for i, m in enumerate(K.MODULES)]
    return union_all(*parts)


@query("callback_run", _all_kinds())
def callback_run(spark, sf):
    """All tables of a first run as they are written, counted by module."""
    from saldoflow.session import fresh_path
    from saldoflow.streaming.feeds import activity_schema

    log = spark.createDataFrame([], activity_schema())
    state = spark.createDataFrame([], "state_key string, watermark timestamp_ntz")
    chart = spark.createDataFrame([], "account_code string, reporting string")
    result = R.run(nine_kinds(spark, sf), R.empty_ledger(spark), log, state, chart,
                   since="1900-01-01", force_watermark=True)
    folder = fresh_path(spark, "run")
    R.write(result, folder)
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    gl = read("gl").groupBy("module").agg(F.count("*").alias("gl_rows"), F.sum("debit").cast("decimal(18,2)").alias("debit"))
    own = union_all(*[read(m).agg(F.lit(m).alias("module"), F.count("*").alias("subledger_rows")) for m in K.MODULES])
    logged = read("activity_log").groupBy("module").agg(F.count("*").alias("activity"))
    failed = result["load"].failed.groupBy("module").agg(F.count("*").alias("failed"))
    counts = gl.join(own, "module").join(logged, "module").join(failed, "module", "left")
    return counts.crossJoin(F.broadcast(read("state").select("watermark"))).withColumn(
        "failed", F.coalesce("failed", F.lit(0)).cast("long"))
