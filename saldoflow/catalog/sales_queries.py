"""Queries: sales detail, daily VAT summary, department master."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window, functions as F

from saldoflow import constants as K
from saldoflow.catalog import inputs as I, query
from saldoflow.operators import ledger as L, daily_vat as V, departments as D, sales_detail as P
from saldoflow.plans import sales_posting as SP
from saldoflow.session import settle

# --- sales detail -----------------------------------------------------------
# An order is an invoice; its lines by line number are the service lines.

SALES_SQL = """
coa AS (SELECT 0 AS seq, '1121-11-000' AS account_code, 'Domestic A/R' AS account_name, 'Balance Sheet' AS reporting UNION ALL
  SELECT 1, '1121-12-000', 'Foreign A/R', 'Balance Sheet' UNION ALL SELECT 2, '2124-11-000', 'Sales VAT', 'Balance Sheet' UNION ALL
  SELECT 10 + row_number() OVER (ORDER BY p_type), '41' || (10 + row_number() OVER (ORDER BY p_type)) || '-00-000',
    'Revenue ' || p_type, 'Profit & Loss' FROM (SELECT DISTINCT p_type FROM part)),
li AS (SELECT l_orderkey AS k, l_linenumber AS n, MIN(l_partkey) AS part,
  SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS subtotal,
  SUM(ROUND(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)) AS tax FROM lineitem GROUP BY 1, 2),
sd AS (SELECT CAST(o_orderdate AS DATE) AS date, 'INV' || k AS ref_no, 'C' || o_custkey AS contact, 'D' || n AS dept_code,
  'Dept ' || n AS dept, 'Line ' || n AS description, 'S' || n AS service_code, 'Service ' || n AS service,
  'Revenue ' || p_type AS account, CAST(CASE WHEN k % 9 = 0 THEN -subtotal ELSE subtotal END AS DECIMAL(18,2)) AS subtotal,
  CAST(CASE WHEN k % 5 = 0 THEN 0 WHEN k % 9 = 0 THEN -tax ELSE tax END AS DECIMAL(18,2)) AS tax,
  CAST(CASE WHEN k % 9 = 0 THEN -1 ELSE 1 END * (subtotal + CASE WHEN k % 5 = 0 THEN 0 ELSE tax END)
    + CASE WHEN k % 50 = 7 AND n = 1 THEN 0.01 ELSE 0 END AS DECIMAL(18,2)) AS total,
  CASE WHEN o_orderstatus = 'P' THEN 'draft' ELSE 'approved' END AS status, CAST(o_orderdate AS TIMESTAMP) AS created_at,
  CASE WHEN k % 4 = 0 THEN 'USD' ELSE 'IDR' END AS currency,
  CAST(CASE WHEN k % 4 = 0 THEN CASE WHEN k % 8 = 0 THEN 0 ELSE 4 END ELSE 1 END AS DECIMAL(18,6)) AS exchange_rate, k, n
  FROM li JOIN orders ON o_orderkey = k JOIN part ON p_partkey = part),
tot AS (SELECT ref_no, SUM(subtotal) AS s, SUM(tax) AS t FROM sd GROUP BY 1),
head AS (SELECT * FROM sd QUALIFY row_number() OVER (PARTITION BY ref_no ORDER BY subtotal DESC, service_code DESC) = 1),
ent AS (
  SELECT h.ref_no, h.description, h.service AS note, h.dept_code, h.dept AS department, s + t AS debit, 0 AS credit,
    CASE h.currency WHEN 'IDR' THEN '112111' ELSE '112112' END AS account_code,
    CASE h.currency WHEN 'IDR' THEN 'Domestic A/R' ELSE 'Foreign A/R' END AS coa_name, '#AR' AS suffix FROM head h JOIN tot USING (ref_no) UNION ALL
  SELECT h.ref_no, h.description, h.service, h.dept_code, h.dept, 0, t, '212411', 'Sales VAT', '#VAT' FROM head h JOIN tot USING (ref_no) WHERE t <> 0 UNION ALL
  SELECT sd.ref_no, sd.description, sd.service, sd.dept_code, sd.dept, 0, sd.subtotal,
    rtrim(replace(coa.account_code, '-', ''), '0'), coa.account_name, '#' || sd.service_code FROM sd JOIN coa ON coa.account_name = sd.account),
journal AS (SELECT 'sales_detail' AS module, 'sales_detail' AS type, e.ref_no AS ref_key, e.ref_no, h.date, h.contact, e.description, e.note,
  e.dept_code, e.department, CAST(NULL AS VARCHAR) AS project, CAST(debit AS DECIMAL(28,2)) AS debit, CAST(credit AS DECIMAL(28,2)) AS credit,
  CAST(debit - credit AS DECIMAL(28,2)) AS amount, e.account_code, e.coa_name, e.ref_no AS source_id, e.ref_no || suffix AS source_line_id,
  h.currency, CAST(CASE WHEN h.exchange_rate = 4 THEN CAST(debit - credit AS DECIMAL(20,4)) / 4 ELSE CAST(debit - credit AS DECIMAL(20,4)) END AS DECIMAL(28,6)) AS original_currency,
  CAST(CASE WHEN h.exchange_rate = 0 THEN 1 ELSE h.exchange_rate END AS DECIMAL(18,6)) AS exchange_rate, h.status, h.created_at,
  CAST(NULL AS VARCHAR) AS created_by FROM ent e JOIN head h USING (ref_no))
"""
_MONEY = ("CAST(CASE WHEN k % 9 = 0 THEN -1 ELSE 1 END * {} AS DECIMAL(18,2))")


def coa(spark, sf):
    fixed = spark.sql("""SELECT * FROM VALUES (0L, '1121-11-000', 'Domestic A/R', 'Balance Sheet'),
        (1L, '1121-12-000', 'Foreign A/R', 'Balance Sheet'), (2L, '2124-11-000', 'Sales VAT', 'Balance Sheet')
        AS t(seq, account_code, account_name, reporting)""")
    # The kinds of part are a fixed handful; numbering them is a small window.
    kinds = I.table(spark, sf, "part").select("p_type").distinct()
    types = kinds.selectExpr("10 + row_number() OVER (ORDER BY p_type) AS i", "p_type").selectExpr(
        "CAST(i AS BIGINT) AS seq", "concat('41', i, '-00-000') AS account_code",
        "concat('Revenue ', p_type) AS account_name", "'Profit & Loss' AS reporting")
    return fixed.unionByName(types)


def sales_detail(spark, sf):
    """Invoice lines as stored."""
    tax = F.when(F.col("k") % 5 == 0, 0).otherwise(F.col("tax"))
    o, part = I.table(spark, sf, "orders"), I.table(spark, sf, "part")
    rows = (I.order_lines(spark, sf).withColumn("tax", tax).join(o, F.col("k") == o.o_orderkey)
            .join(part, F.col("part") == part.p_partkey))
    return rows.selectExpr(
        "CAST(o_orderdate AS DATE) AS date", "concat('INV', k) AS ref_no", "concat('C', o_custkey) AS contact",
        "concat('D', n) AS dept_code", "concat('Dept ', n) AS dept", "concat('Line ', n) AS description",
        "concat('S', n) AS service_code", "concat('Service ', n) AS service", "concat('Revenue ', p_type) AS account",
        f"{_MONEY.format('gross')} AS subtotal", f"{_MONEY.format('tax')} AS tax",
        f"CAST({_MONEY.format('(gross + tax)')} + IF(k % 50 = 7 AND n = 1, CAST(0.01 AS DECIMAL(4,2)), 0) AS DECIMAL(18,2)) AS total",
        "IF(o_orderstatus = 'P', 'draft', 'approved') AS status", "CAST(o_orderdate AS TIMESTAMP_NTZ) AS created_at",
        "IF(k % 4 = 0, 'USD', 'IDR') AS currency",
        "CAST(IF(k % 4 = 0, IF(k % 8 = 0, 0, 4), 1) AS DECIMAL(18,6)) AS exchange_rate", "k", "n")


def resolver(spark, sf):
    return P.coa_resolver(coa(spark, sf))


def _journal_types(df):
    return df.withColumn("original_currency", F.col("original_currency").cast("decimal(28,6)"))


@query("coa_resolver", f"""WITH {SALES_SQL}
SELECT account_name AS account_key, rtrim(replace(account_code, '-', ''), '0') AS short_code, account_name AS coa_name FROM coa
UNION ALL SELECT account_code, rtrim(replace(account_code, '-', ''), '0'), account_name FROM coa""")
def coa_resolver(spark, sf):
    return resolver(spark, sf)


@query("unmapped_accounts", f"""WITH {SALES_SQL} SELECT ref_no, service_code, account FROM sd
WHERE account = 'Revenue PROMO'""")
def unmapped_accounts(spark, sf):
    part = resolver(spark, sf).filter("account_key <> 'Revenue PROMO'")
    return P.unmapped_accounts(sales_detail(spark, sf), part).select("ref_no", "service_code", "account")


@query("dominant_line", f"WITH {SALES_SQL} SELECT ref_no, service_code, subtotal, description FROM head")
def dominant_line(spark, sf):
    return P.dominant_line(sales_detail(spark, sf)).select("ref_no", "service_code", "subtotal", "description")


@query("sales_invoice_journal", f"WITH {SALES_SQL} SELECT * FROM journal")
def sales_invoice_journal(spark, sf):
    return _journal_types(P.sales_invoice_journal(sales_detail(spark, sf), resolver(spark, sf)))


@query("journal_unbalanced", f"""WITH {SALES_SQL},
j AS (SELECT ref_no, debit + CASE WHEN source_line_id LIKE '%7#AR' THEN 1 ELSE 0 END AS debit, credit FROM journal)
SELECT ref_no FROM j GROUP BY 1 HAVING ABS(SUM(debit - credit)) > 0.005""")
def journal_unbalanced(spark, sf):
    j = P.sales_invoice_journal(sales_detail(spark, sf), resolver(spark, sf))
    broken = j.withColumn("debit", F.col("debit") + F.when(F.col("source_line_id").like("%7#AR"), 1).otherwise(0))
    return P.journal_unbalanced(broken)


@query("sales_detail_check", f"""WITH {SALES_SQL}
SELECT COUNT(*) AS lines, COUNT(DISTINCT ref_no) AS invoices, (SELECT COUNT(*) FROM journal) AS gl_rows,
  CAST(0 AS BIGINT) AS unmapped, COUNT(*) FILTER (ABS(subtotal + tax - total) > 0.005) AS total_drift_rows,
  CAST(SUM(subtotal) AS DECIMAL(38,2)) AS subtotal, CAST(SUM(tax) AS DECIMAL(38,2)) AS tax,
  CAST(SUM(total) AS DECIMAL(38,2)) AS total, true AS ok FROM sd""")
def sales_detail_check(spark, sf):
    return P.sales_detail_check(sales_detail(spark, sf), resolver(spark, sf))


@query("sales_detail_read", f"""WITH {SALES_SQL} SELECT ref_no, service_code, date, subtotal FROM sd
WHERE date >= DATE '1997-03-01' AND date < DATE '1997-04-01' AND k % 3 = 0""")
def sales_detail_read(spark, sf):
    refs = I.table(spark, sf, "orders").filter("o_orderkey % 3 = 0").selectExpr("concat('INV', o_orderkey) AS ref_no")
    rows = P.sales_detail_read(sales_detail(spark, sf), "1997-03-01", refs)
    return rows.select("ref_no", "service_code", "date", "subtotal")


@query("sales_sheet_normalise", f"""WITH {SALES_SQL}
SELECT ref_no, service_code, CASE WHEN k % 10 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE subtotal END AS subtotal, tax,
  CASE WHEN k % 4 = 0 THEN 'USD' ELSE 'IDR' END AS currency,
  CAST(CASE WHEN k % 6 = 0 THEN 1 ELSE exchange_rate END AS DECIMAL(18,6)) AS exchange_rate,
  CASE WHEN k % 7 <> 0 THEN date END AS date,
  CASE WHEN k % 11 <> 0 THEN rtrim(replace(coa.account_code, '-', ''), '0') END AS account_code
FROM sd JOIN coa ON coa.account_name = sd.account""")
def sales_sheet_normalise(spark, sf):
    """A sheet of texts: bad numbers, bad dates, odd currencies, odd headers."""
    sheet = sales_detail(spark, sf).selectExpr(
        "ref_no", "service_code AS ` service_code `", "IF(k % 10 = 0, 'n/a', CAST(subtotal AS STRING)) AS subtotal",
        "CAST(tax AS STRING) AS tax", "CAST(total AS STRING) AS total", "IF(k % 4 = 0, ' usd ', NULL) AS currency",
        "IF(k % 6 = 0, '', CAST(exchange_rate AS STRING)) AS exchange_rate",
        "IF(k % 7 = 0, 'soon', CAST(date AS STRING)) AS date",
        "IF(k % 11 = 0, 'Nowhere', concat(' ', account)) AS account", "'x' AS `unknown header`")
    rows = P.sales_sheet_normalise(sheet, resolver(spark, sf))
    return rows.select("ref_no", "service_code", "subtotal", "tax", "currency", "exchange_rate", "date", "account_code")


# A ledger that lacks some invoices, has stale ones, and orphans.
_POSTED = """p AS (SELECT * REPLACE (CAST(CASE WHEN CAST(substr(ref_no, 4) AS BIGINT) % 8 = 1 AND source_line_id LIKE '%#AR'
    THEN debit + 1 ELSE debit END AS DECIMAL(28,2)) AS debit) FROM journal WHERE CAST(substr(ref_no, 4) AS BIGINT) % 8 <> 2
  UNION ALL SELECT * REPLACE ('X' || ref_no AS ref_no, 'X' || ref_no AS source_id, 'X' || ref_no AS ref_key,
    'X' || source_line_id AS source_line_id) FROM journal WHERE CAST(substr(ref_no, 4) AS BIGINT) % 8 = 3)"""


def _posted(journal):
    n = F.expr("substring(ref_no, 4)").cast("bigint") % 8
    stale = (n == 1) & F.col("source_line_id").endswith("#AR")
    kept = journal.filter(n != 2).withColumn(
        "debit", F.when(stale, F.col("debit") + 1).otherwise(F.col("debit")).cast("decimal(28,2)"))
    # Both copies of an orphan come from its one row: a union would make the journal twice.
    both = kept.withColumn("_x", F.explode(F.when(n == 3, F.array(F.lit(""), F.lit("X"))).otherwise(F.array(F.lit("")))))
    for c in ("ref_no", "source_id", "ref_key", "source_line_id"):
        both = both.withColumn(c, F.concat("_x", c))
    return both.drop("_x")


_STATUS = """status AS (SELECT ref_no, CAST(e.expected AS DECIMAL(28,2)) AS expected,
  CAST(COALESCE(g.posted, 0) AS DECIMAL(28,2)) AS posted,
  CASE WHEN e.expected IS NULL THEN 'orphan' WHEN g.posted IS NULL THEN 'unposted'
    WHEN ABS(e.expected - g.posted) > 0.005 THEN 'stale' ELSE 'in_sync' END AS state
  FROM (SELECT ref_no, s + t AS expected FROM tot) e FULL JOIN
    (SELECT source_id AS ref_no, SUM(debit) FILTER (source_line_id LIKE '%#AR') AS posted FROM p GROUP BY 1) g USING (ref_no))"""


def _status(spark, sf):
    lines = sales_detail(spark, sf)
    return P.posting_status(lines, _posted(P.sales_invoice_journal(lines, resolver(spark, sf))))


@query("posting_status", f"WITH {SALES_SQL}, {_POSTED}, {_STATUS} SELECT * FROM status")
def posting_status(spark, sf):
    return _status(spark, sf)


@query("posting_in_sync", f"""WITH {SALES_SQL}, {_POSTED}, {_STATUS}
SELECT COUNT(*) FILTER (state <> 'orphan') AS invoices, COUNT(*) FILTER (state = 'unposted') AS unposted,
  COUNT(*) FILTER (state = 'stale') AS stale, COUNT(*) FILTER (state = 'orphan') AS orphan,
  COUNT(*) FILTER (state <> 'in_sync') = 0 AS in_sync FROM status""")
def posting_in_sync(spark, sf):
    return P.posting_in_sync(_status(spark, sf))


_KEEP = ["type", "source_id", "source_line_id", "debit", "credit", "amount", "account_code", "coa_code", "reporting"]
_WITH_COA = """SELECT {0}.type, {0}.source_id, {0}.source_line_id, {0}.debit, {0}.credit, {0}.amount, {0}.account_code,
  coa.account_code AS coa_code, coa.reporting FROM {0} LEFT JOIN coa ON rtrim(replace(coa.account_code, '-', ''), '0') = {0}.account_code"""


@query("sales_detail_repost", f"WITH {SALES_SQL} {_WITH_COA.format('journal')}")
def sales_detail_repost(spark, sf):
    """A full run over a ledger with stale, missing and orphan entries."""
    lines = settle(sales_detail(spark, sf), "lines")
    ledger = _posted(P.sales_invoice_journal(lines, resolver(spark, sf)))
    return SP.sales_detail_repost(ledger, lines, coa(spark, sf)).select(*_KEEP)


@query("sales_detail_import", f"""WITH {SALES_SQL}, {_POSTED},
x AS (SELECT * FROM journal WHERE CAST(substr(ref_no, 4) AS BIGINT) % 8 < 4 UNION ALL
      SELECT * FROM p WHERE ref_no LIKE 'X%' OR CAST(substr(ref_no, 4) AS BIGINT) % 8 >= 4)
{_WITH_COA.format('x')}
UNION ALL SELECT 'stored line', ref_no, service_code, NULL, NULL,
  subtotal + CASE WHEN k % 8 >= 4 THEN 1 ELSE 0 END, NULL, NULL, NULL FROM sd""")
def sales_detail_import(spark, sf):
    """A sheet with half of the invoices, imported over a ledger that has drifted and
    over stored lines that are older versions of some of them."""
    lines, chart = sales_detail(spark, sf), coa(spark, sf)
    ledger = L.gl_reporting_enrich(_posted(P.sales_invoice_journal(lines, resolver(spark, sf))), chart)
    half = lines.filter("k % 8 < 4").drop("k", "n")
    older = P.sales_sheet_normalise(lines.filter("k % 8 >= 2").drop("k", "n"), resolver(spark, sf))
    older = older.withColumn("subtotal", (F.col("subtotal") + 1).cast("decimal(18,2)"))
    stored, after = SP.sales_detail_import(older, ledger, half, chart, _NOW)
    rows = stored.select(F.lit("stored line").alias("type"), F.col("ref_no").alias("source_id"),
                         F.col("service_code").alias("source_line_id"), F.col("subtotal").cast("decimal(28,2)").alias("amount"))
    return after.select(*_KEEP).unionByName(rows, allowMissingColumns=True)


@query("sales_detail_autopost", f"""WITH {SALES_SQL}, {_POSTED},
x AS (SELECT * FROM journal WHERE CAST(substr(ref_no, 4) AS BIGINT) % 4 = 1 UNION ALL
  SELECT * FROM p WHERE ref_no LIKE 'X%' OR CAST(substr(ref_no, 4) AS BIGINT) % 4 <> 1)
{_WITH_COA.format('x')}""")
def sales_detail_autopost(spark, sf):
    """Invoices whose stored lines changed, posted again on a ledger that carries the chart's codes.

    Nothing names them: the earlier version of the lines differs from the current one in
    every fourth invoice - a line's amount or text updated, a line inserted, a line
    deleted - and the operator finds these by comparing the two versions.
    """
    lines, chart = settle(sales_detail(spark, sf), "lines"), coa(spark, sf)
    ledger = L.gl_reporting_enrich(_posted(P.sales_invoice_journal(lines, resolver(spark, sf))), chart)
    earlier = settle(earlier_lines(lines), "earlier-lines")
    return P.sales_detail_autopost_versions(ledger, earlier, lines, chart).select(*_KEEP)


def earlier_lines(lines):
    """An earlier version of the stored lines: invoices k % 4 = 1 differ from ``lines``."""
    lines = lines.withColumn("_first", F.col("n") == F.min("n").over(Window.partitionBy("k")))
    first, group = F.col("_first"), F.col("k") % 16
    updated = (lines.filter(~((group == 5) & first))
               .withColumn("subtotal", F.when((group == 1) & first, F.col("subtotal") + 1)
                           .otherwise(F.col("subtotal")).cast("decimal(18,2)"))
               .withColumn("description", F.when((group == 13) & first, F.lit("Line 1 (draft)"))
                           .otherwise(F.col("description"))))
    extra = lines.filter((group == 9) & first).withColumn("n", F.lit(99).cast(lines.schema["n"].dataType)).withColumn(
        "service_code", F.lit("S99"))
    return updated.unionByName(extra).drop("_first")


# --- daily VAT --------------------------------------------------------------

_VAT_SQL = """tr AS (SELECT o_orderkey AS transaction_id, o_totalprice AS total_amount, CAST(o_orderdate AS DATE) AS summary_date
  FROM orders WHERE o_orderstatus = 'F'),
tax AS (SELECT *, round_even(total_amount * 0.11::DOUBLE * 100, 0) / 100 AS tax_amount FROM tr),
full_tax AS (SELECT *, round_even((total_amount - tax_amount) * 100, 0) / 100 AS net_amount,
  round_even((total_amount + tax_amount) * 100, 0) / 100 AS gross_amount FROM tax)"""


def transactions(spark, sf):
    return I.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS transaction_id", "o_totalprice AS total_amount", "o_orderdate AS created_at",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status")


@query("filter_completed", f"WITH {_VAT_SQL} SELECT * FROM tr")
def filter_completed(spark, sf):
    return V.filter_completed(transactions(spark, sf)).select("transaction_id", "total_amount", "summary_date")


@query("vat_columns", f"""WITH {_VAT_SQL} SELECT transaction_id, CAST(tax_amount AS DECIMAL(18,2)) AS tax_amount,
  CAST(net_amount AS DECIMAL(18,2)) AS net_amount, CAST(gross_amount AS DECIMAL(18,2)) AS gross_amount FROM full_tax""")
def vat_columns(spark, sf):
    rows = V.vat_columns(V.filter_completed(transactions(spark, sf)))
    return rows.select("transaction_id", *[F.col(c).cast("decimal(18,2)").alias(c)
                                           for c in ("tax_amount", "net_amount", "gross_amount")])


@query("daily_summary", f"""WITH {_VAT_SQL},
d AS (SELECT summary_date, SUM(gross_amount) AS g, SUM(net_amount) AS n, SUM(tax_amount) AS t, COUNT(*) AS c FROM full_tax GROUP BY 1),
r AS (SELECT summary_date, 1 AS account_id, g AS dr, 0 AS cr, g AS v, c FROM d UNION ALL SELECT summary_date, 2, 0, n, n, c FROM d
  UNION ALL SELECT summary_date, 3, 0, t, t, c FROM d)
SELECT summary_date, account_id, CAST(ROUND(dr, 2) AS DECIMAL(18,2)) AS total_debit, CAST(ROUND(cr, 2) AS DECIMAL(18,2)) AS total_credit,
  CAST(ROUND(v, 2) AS DECIMAL(18,2)) AS net_amount, c AS transaction_count FROM r""")
def daily_summary(spark, sf):
    rows = V.transform(transactions(spark, sf))
    return rows.select("summary_date", "account_id", *[F.col(c).cast("decimal(18,2)").alias(c)
                                                       for c in ("total_debit", "total_credit", "net_amount")],
                       "transaction_count")


# --- departments ------------------------------------------------------------
# Nations are departments; the listing lacks some and has some more.

_DEPT_SQL = """m AS (SELECT 'N' || n_nationkey AS dept_code, 'Old ' || n_name AS dept_name, TIMESTAMP '2020-01-01 00:00:00' AS created_at,
  TIMESTAMP '2020-01-01 00:00:00' AS updated_at FROM nation WHERE n_nationkey < 20),
l AS (SELECT 'N' || n_nationkey AS dept_code, n_name AS dept_name FROM nation WHERE n_nationkey >= 5)"""
_NOW = "2026-01-01 00:00:00"


def master(spark, sf):
    return I.table(spark, sf, "nation").filter("n_nationkey < 20").selectExpr(
        "concat('N', n_nationkey) AS dept_code", "concat('Old ', n_name) AS dept_name",
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS created_at", "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS updated_at")


def listing(spark, sf):
    return I.table(spark, sf, "nation").filter("n_nationkey >= 5").selectExpr(
        "concat('N', n_nationkey) AS dept_code", "n_name AS dept_name")


@query("department_upsert", f"""WITH {_DEPT_SQL}
SELECT dept_code, COALESCE(l.dept_name, m.dept_name) AS dept_name,
  CASE WHEN m.dept_code IS NULL THEN TIMESTAMP '{_NOW}' ELSE m.created_at END AS created_at,
  CASE WHEN l.dept_code IS NULL THEN m.updated_at ELSE TIMESTAMP '{_NOW}' END AS updated_at
FROM m FULL JOIN l USING (dept_code)""")
def department_upsert(spark, sf):
    return D.department_upsert(master(spark, sf), listing(spark, sf), _NOW)


@query("department_surplus", f"WITH {_DEPT_SQL} SELECT dept_code FROM m WHERE dept_code NOT IN (SELECT dept_code FROM l)")
def department_surplus(spark, sf):
    return D.department_surplus(master(spark, sf), listing(spark, sf))


@query("department_prune", f"WITH {_DEPT_SQL} SELECT dept_code, dept_name FROM m WHERE dept_code IN (SELECT dept_code FROM l)")
def department_prune(spark, sf):
    return D.department_prune(master(spark, sf), listing(spark, sf)).select("dept_code", "dept_name")


# Ledgers by year of order: the code of the customer's nation, some missing.
_LEDGERS = """ledgers AS (SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'gl' WHEN 1 THEN 'cash_in' ELSE 'cash_out' END AS table_name,
  CASE WHEN o_orderkey % 6 <> 5 THEN 'N' || c_nationkey END AS dept_code,
  CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Old NATION_' || c_nationkey ELSE 'Stale' END AS department
  FROM orders JOIN customer ON c_custkey = o_custkey)"""


def ledgers(spark, sf):
    o, c = I.table(spark, sf, "orders"), I.table(spark, sf, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).selectExpr(
        "o_orderkey AS id",
        "CASE o_orderkey % 3 WHEN 0 THEN 'gl' WHEN 1 THEN 'cash_in' ELSE 'cash_out' END AS table_name",
        "IF(o_orderkey % 6 <> 5, concat('N', c_nationkey), NULL) AS dept_code",
        "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('Old NATION_', c_nationkey) ELSE 'Stale' END AS department")
    return {t: rows.filter(F.col("table_name") == t) for t in ("gl", "cash_in", "cash_out")}


@query("department_unexplained", f"""WITH {_DEPT_SQL}, {_LEDGERS}
SELECT DISTINCT table_name, dept_code FROM ledgers WHERE dept_code IS NOT NULL AND dept_code NOT IN (SELECT dept_code FROM l)""")
def department_unexplained(spark, sf):
    return D.department_unexplained(ledgers(spark, sf), listing(spark, sf))


@query("department_canonicalise", f"""WITH {_DEPT_SQL}, {_LEDGERS}
SELECT table_name, id, dept_code, COALESCE(m.dept_name, department) AS department FROM ledgers LEFT JOIN m USING (dept_code)""")
def department_canonicalise(spark, sf):
    done = [D.department_canonicalise(t, master(spark, sf)).select("table_name", "id", "dept_code", "department")
            for t in ledgers(spark, sf).values()]
    return reduce(lambda a, b: a.unionByName(b), done)


@query("department_stale_count", f"""WITH {_DEPT_SQL}, {_LEDGERS}
SELECT table_name, COUNT(*) FILTER (m.dept_name IS NOT NULL AND department IS DISTINCT FROM m.dept_name) AS stale
FROM ledgers LEFT JOIN m USING (dept_code) GROUP BY 1""")
def department_stale_count(spark, sf):
    tables = {n: (t, "department") for n, t in ledgers(spark, sf).items()}
    return D.department_stale_count(tables, master(spark, sf))
