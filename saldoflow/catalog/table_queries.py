"""Queries: stored tables, sheets, snapshot and one-off rewrites.

Each writes to the shared folder, and returns what is read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from saldoflow.catalog import inputs as I, query
from saldoflow.catalog import distribution_queries as DQ
from saldoflow.catalog.sales_queries import listing
from saldoflow.operators import distribution as D, rewrites as W
from saldoflow.plans import distribution_run as R
from saldoflow.session import fresh_path, settle
from saldoflow.sources import sheets as SH, tables as TB


def _orders(spark, sf):
    return I.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                               I.money("o_totalprice").alias("price"))


_O = "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders"


@query("table_append", f"{_O} UNION ALL {_O} WHERE o_orderstatus = 'F'")
def table_append(spark, sf):
    path = fresh_path(spark, "append")
    TB.table_append(_orders(spark, sf), path)
    TB.table_append(_orders(spark, sf).filter("o_orderstatus = 'F'"), path)
    return spark.read.parquet(path)


@query("table_replace", f"{_O} WHERE o_orderstatus = 'F'")
def table_replace(spark, sf):
    path = fresh_path(spark, "replace")
    TB.table_replace(_orders(spark, sf), path)
    TB.table_replace(_orders(spark, sf).filter("o_orderstatus = 'F'"), path)
    return spark.read.parquet(path)


_UPSERT = f"""WITH o AS ({_O})
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'N' ELSE o_orderstatus END AS o_orderstatus, price FROM o"""


def _halves(spark, sf):
    o = _orders(spark, sf)
    # Stored is all but every sixth order; each third comes again or anew.
    return o.filter("o_orderkey % 6 <> 3"), o.filter("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("N"))


@query("keyed_upsert", _UPSERT)
def keyed_upsert(spark, sf):
    return TB.keyed_upsert(*_halves(spark, sf), ["o_orderkey"])


@query("keyed_upsert_stored", _UPSERT)
def keyed_upsert_stored(spark, sf):
    """The same in a stored table, touching only the buckets of the batch."""
    target, new = _halves(spark, sf)
    path = fresh_path(spark, "buckets")
    TB.replace_partitions(TB.bucketed(target, 8, "o_orderkey"), path, [TB.BUCKET])
    TB.upsert_buckets(spark, path, new, ["o_orderkey"], 8, "o_orderkey")
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderstatus", "price")


def _sheet_folder(spark, sf):
    """The sheets written as CSV files with their headers, and ``seq`` where there may be several files."""
    folder = fresh_path(spark, "sheets")
    for name, df in DQ.sheets(spark, sf).items():
        ordered = df.orderBy("seq") if "seq" in df.columns else df.withColumn("seq", F.monotonically_increasing_id())
        SH.to_headers(ordered, name) \
            .write.option("header", True).csv(f"{folder}/{name}")
    return folder


@query("sheet_tables_read", f"""WITH {DQ.SHEETS_SQL} SELECT 'PC' AS sheet, COUNT(*) AS n, MIN(dept_code) AS a, MAX(pc) AS b FROM pc UNION ALL
SELECT 'COA', COUNT(*), MIN(code), MAX(reporting_account) FROM coa UNION ALL SELECT 'LOGIC', COUNT(*), MIN(account_code), MAX(distribution) FROM logic UNION ALL
SELECT 'ALLOCATION', COUNT(*), MIN(new_dept), CAST(COUNT(DISTINCT distribution) AS VARCHAR) FROM alloc UNION ALL
SELECT 'FTE', COUNT(*), MIN(dept), CAST(CAST(SUM(hc) AS BIGINT) AS VARCHAR) FROM fte UNION ALL
SELECT 'REV', COUNT(*), MIN(div), CAST(ROUND(SUM(pct_all), 4) AS VARCHAR) FROM rev""")
def sheet_tables_read(spark, sf):
    s = SH.sheet_tables_read(spark, _sheet_folder(spark, sf), ["PC", "COA", "RL", "LOGIC", "ALLOCATION", "FTE", "REV"])
    facts = {"PC": (F.min("dept_code"), F.max("pc")), "COA": (F.min("code"), F.max("reporting_account")),
             "LOGIC": (F.min("account_code"), F.max("distribution")),
             "ALLOCATION": (F.min("new_dept"), F.count_distinct("distribution").cast("string")),
             "FTE": (F.min("dept"), F.sum("hc").cast("bigint").cast("string")),
             "REV": (F.min("div"), F.round(F.sum("pct_all"), 4).cast("string"))}
    return D.union_all(*[s[n].agg(F.lit(n).alias("sheet"), F.count("*").alias("n"), a.alias("a"), b.alias("b"))
                         for n, (a, b) in facts.items()])


@query("department_listing_read", "SELECT 'N' || n_nationkey AS dept_code, n_name AS dept_name FROM nation WHERE n_nationkey >= 5")
def department_listing_read(spark, sf):
    """A tab-separated listing with padded cells and a blank row."""
    path = fresh_path(spark, "listing")
    rows = listing(spark, sf).selectExpr("concat(' ', dept_code, ' ') AS `DEPARTMENT NO `", "concat(dept_name, '  ') AS `DEPARTMENT NAME`", "'x' AS `OTHER`")
    blank = spark.sql("SELECT ' ' AS `DEPARTMENT NO `, 'nobody' AS `DEPARTMENT NAME`, 'x' AS `OTHER`")
    rows.unionByName(blank).write.option("header", True).option("sep", "\t").csv(path)
    return SH.department_listing_read(spark, path)


def _seeded(spark, sf):
    s = DQ.sheets(spark, sf)
    s["ALLOCATION"] = s["ALLOCATION"].withColumn("basis", F.lit(None).cast("string"))
    first, _ = SH.basis_seed(s, {}, "1997-03-01")
    stored = {n: settle(df, n) for n, df in first.items()}
    # Another month; the policy tables are there already and stay.
    s["LOGIC"] = s["LOGIC"].withColumn("distribution", F.lit("changed"))
    second, _ = SH.basis_seed(s, stored, "1997-04-01")
    again, written = SH.basis_seed(s, second, "1997-04-01")
    return again, written


_SEEDED = f"""WITH {DQ.SHEETS_SQL}, months AS (SELECT DATE '1997-03-01' AS period UNION ALL SELECT DATE '1997-04-01')
SELECT 'ALLOCATION' AS sheet, period, COUNT(*) AS n, MIN(CASE WHEN distribution LIKE 'FTE%' THEN 'basis_fte' ELSE NULL END) AS note FROM alloc, months GROUP BY 2 UNION ALL
SELECT 'FTE', period, COUNT(*), NULL FROM fte, months GROUP BY 2 UNION ALL SELECT 'REV', period, COUNT(*), NULL FROM rev, months GROUP BY 2 UNION ALL
SELECT 'LOGIC', NULL, COUNT(*), MIN(distribution) FROM logic UNION ALL SELECT 'PC', NULL, COUNT(*), NULL FROM pc UNION ALL SELECT 'COA', NULL, COUNT(*), NULL FROM coa"""


@query("basis_seed", _SEEDED)
def basis_seed(spark, sf):
    tables, _ = _seeded(spark, sf)
    notes = {"ALLOCATION": F.min(F.when(F.col("basis") == "basis_fte", F.col("basis"))),
             "LOGIC": F.min("distribution")}
    parts = []
    for name, t in tables.items():
        t = t if "period" in t.columns else t.withColumn("period", F.lit(None).cast("date"))
        parts.append(t.groupBy("period").agg(F.count("*").alias("n"), notes.get(name, F.lit(None).cast("string")).alias("note"))
                     .withColumn("sheet", F.lit(name)))
    return D.union_all(*parts).select("sheet", "period", "n", "note")


@query("basis_read", f"WITH {DQ.SHEETS_SQL} SELECT distribution, new_dept, ROUND(percentage, 9) AS percentage FROM alloc")
def basis_read(spark, sf):
    tables, _ = _seeded(spark, sf)
    rows = SH.require_rows(SH.basis_read(tables, "1997-04-01", "ALLOCATION"), "ALLOCATION", "1997-04-01")
    return rows.select("distribution", "new_dept", F.round("percentage", 9).alias("percentage"))


@query("allocation_persist", f"""WITH {DQ.SHEETS_SQL}, {DQ._SCOPES}
SELECT DATE '1997-03-01' AS period, distribution, COUNT(*) AS n, ROUND(SUM(percentage), 6) AS total FROM stored GROUP BY 2 UNION ALL
SELECT DATE '1997-04-01', distribution, COUNT(*), ROUND(SUM(percentage), 6) FROM fresh GROUP BY 2""")
def allocation_persist(spark, sf):
    old = DQ.full_roster(spark, sf).withColumn("basis", F.lit("old"))
    stored = D.union_all(*[old.withColumn("period", F.lit(p).cast("date")) for p in ("1997-03-01", "1997-04-01")])
    after = SH.allocation_persist(stored, DQ._fresh(spark, sf), "1997-04-01")
    return after.groupBy("period", "distribution").agg(F.count("*").alias("n"), F.round(F.sum("percentage"), 6).alias("total"))


def _entries(spark, sf):
    gl = DQ.ledger(spark, sf).withColumn(
        "dept", F.when(F.col("seq") % 2 == 0, " CERTIFICATION SERVICES ").otherwise(F.col("dept")))
    stored = gl.limit(0).withColumn("period", F.lit(None).cast("date"))
    for month in ("1997-03-01", "1997-04-01", "1997-03-01"):
        stored = SH.gl_entry_seed_sheet(gl, stored, month)
    return stored


_ENTRY = f"""SELECT seq, date, CASE WHEN seq % 2 = 0 THEN 'System Certification Services' ELSE dept END AS dept, account_code,
  {DQ._m('debit')} {{0}} FROM gl WHERE"""


@query("gl_entry_seed_sheet", f"""WITH {DQ.SHEETS_SQL}, {DQ.GL_SQL} {_ENTRY.format(", CAST(date_trunc('month', date) AS DATE) AS period")}
date >= DATE '1997-03-01' AND date < DATE '1997-05-01'""")
def gl_entry_seed_sheet(spark, sf):
    return DQ.cents(_entries(spark, sf), "seq", "date", "dept", "account_code", "debit", "period")


@query("gl_entry_read", f"""WITH {DQ.SHEETS_SQL}, {DQ.GL_SQL} {_ENTRY.format('')} date >= DATE '1997-04-01' AND date < DATE '1997-05-01'""")
def gl_entry_read(spark, sf):
    return DQ.cents(SH.gl_entry_read(_entries(spark, sf), "1997-04-01"), "seq", "date", "dept", "account_code", "debit")


@query("distribution_write", f"""WITH {DQ.ALL_SQL}, {DQ._RECON}
SELECT 'Distribution' AS output, COUNT(*) AS n, {DQ._c('SUM(allocation)', 'total')} FROM base UNION ALL
SELECT 'Overhead', COUNT(*), {DQ._c('SUM(allocation)', 'total')} FROM sweep WHERE amount < 0 AND percentage = 1 UNION ALL
SELECT 'Reconciliation', CAST(n_output_rows AS BIGINT), {DQ._c('source_total', 'total')} FROM recon""")
def distribution_write(spark, sf):
    r = DQ.run(spark, sf)
    folder = fresh_path(spark, "output")
    R.write(r, R.validate(r), folder)
    out = spark.read.parquet(f"{folder}/Distribution")
    over = F.col("Distribution And Allocation").startswith("FTE : PC")
    parts = [
        out.filter(~F.coalesce(over, F.lit(False))).agg(F.lit("Distribution").alias("output"), F.count("*").alias("n"),
                                                        DQ.cent(F.sum("Allocation")).alias("total")),
        out.filter(over & (F.col("Amount") < 0) & (F.col("Percentage") == 1)).agg(
            F.lit("Overhead").alias("output"), F.count("*").alias("n"), DQ.cent(F.sum("Allocation")).alias("total")),
        spark.read.parquet(f"{folder}/Reconciliation").select(
            F.lit("Reconciliation").alias("output"), F.col("Output Rows").alias("n"), DQ.cent(F.col("Source Total")).alias("total"))]
    return D.union_all(*parts)


_SNAP = "date >= DATE '1997-03-01' AND date < DATE '1997-05-01'"


@query("distribution_snapshot_replace", f"""WITH {DQ.ALL_SQL},
x AS (SELECT 1 AS run_id, period, 1 AS n FROM base WHERE period NOT IN (DATE '1997-03-01', DATE '1997-04-01') OR period IS NULL UNION ALL
  SELECT 1, period, 1 FROM sweep WHERE period NOT IN (DATE '1997-03-01', DATE '1997-04-01') UNION ALL
  SELECT 2, period, 1 FROM base WHERE {_SNAP} UNION ALL SELECT 2, period, 1 FROM sweep WHERE period IN (DATE '1997-03-01', DATE '1997-04-01'))
SELECT CAST(run_id AS BIGINT) AS run_id, period, COUNT(*) AS n FROM x GROUP BY 1, 2""")
def distribution_snapshot_replace(spark, sf):
    """A whole snapshot, then two of its months distributed again."""
    s = DQ.sheets(spark, sf)
    gl = DQ.numbered(spark, sf)
    first = R.distribute(gl, s)
    stored = settle(D.distribution_stored(first.out, 1), "snapshot")
    second = R.distribute(gl.filter(_SNAP), s)
    locks = DQ._locks(spark, sf).filter("period = DATE '1997-08-01'")
    after, _ = R.snapshot_replace(stored, second, R.validate(second), locks, 2)
    return after.groupBy("run_id", "period").agg(F.count("*").alias("n"))


# --- rewrites ---------------------------------------------------------------

_LABEL = "upper(strftime(o_orderdate, '%b-%Y'))"


@query("period_label_to_date", """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS period FROM orders""")
def period_label_to_date(spark, sf):
    t = I.table(spark, sf, "orders").selectExpr("o_orderkey AS k", "IF(o_orderkey % 9 = 0, 'none', upper(date_format(o_orderdate, 'MMM-yyyy'))) AS period")
    return W.period_label_to_date(t)


@query("period_date_to_label", f"SELECT o_orderkey AS k, {_LABEL} AS period FROM orders")
def period_date_to_label(spark, sf):
    t = I.table(spark, sf, "orders").selectExpr("o_orderkey AS k", "CAST(date_trunc('MONTH', o_orderdate) AS DATE) AS period")
    return W.period_date_to_label(t)


@query("stamp_shift", """SELECT o_orderkey AS k, o_orderdate + INTERVAL 7 HOUR AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at, o_orderdate AS closed_at FROM orders""")
def stamp_shift(spark, sf):
    t = I.table(spark, sf, "orders").selectExpr("o_orderkey AS k", "CAST(o_orderdate AS TIMESTAMP_NTZ) AS created_at",
                                                "CAST(NULL AS TIMESTAMP_NTZ) AS updated_at", "CAST(o_orderdate AS TIMESTAMP_NTZ) AS closed_at")
    return W.stamp_shift(t)


@query("stamp_fill", """WITH t AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2026-01-01 00:00:00' ELSE o_orderdate END AS created_at,
  CASE WHEN o_orderkey % 2 = 1 THEN o_orderdate END AS u FROM orders) SELECT k, created_at, COALESCE(u, created_at) AS updated_at FROM t""")
def stamp_fill(spark, sf):
    t = I.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS k", "IF(o_orderkey % 3 = 0, NULL, CAST(o_orderdate AS TIMESTAMP_NTZ)) AS created_at",
        "IF(o_orderkey % 2 = 1, CAST(o_orderdate AS TIMESTAMP_NTZ), NULL) AS updated_at")
    return W.stamp_fill(t, "2026-01-01 00:00:00")


@query("basis_label_backfill", """SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'basis_fte' WHEN 1 THEN 'basis_rev' WHEN 2 THEN 'basis_rev' ELSE 'Fixed' END AS basis FROM orders""")
def basis_label_backfill(spark, sf):
    former = next(iter(W.FORMER_METHODS))
    t = I.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.expr(
        f"CASE o_orderkey % 4 WHEN 0 THEN 'FTE - Medan' WHEN 1 THEN '{former}' WHEN 2 THEN 'Revenue' ELSE 'Lab Distribution' END").alias("distribution"))
    return W.basis_label_backfill(t).select("k", "basis")
