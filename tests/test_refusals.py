"""What must stop a load, and tables that a batch must leave alone."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from saldoflow.catalog import sales_queries as SQ
from saldoflow.operators import daily_vat as V, distribution as D, ledger as L, sales_detail as P
from saldoflow.operators.ordering import bracketed_quantiles, exact_quantiles
from saldoflow.plans import distribution_run as R, sales_posting as SP
from saldoflow.sources import callbacks as C, sheets as SH, tables as TB

COA = [(0, "1121-11-000", "Domestic A/R", "Balance"), (1, "1121-12-000", "Foreign A/R", "Balance"),
       (2, "2124-11-000", "Sales VAT", "Balance"), (3, "4125-10-000", "Testing", "Profit")]


def coa(spark):
    return spark.createDataFrame(COA, "seq int, account_code string, account_name string, reporting string")


def lines(spark, *rows):
    sheet = spark.createDataFrame([(a, b, c, d, "0", "IDR") for a, b, c, d in rows],
                                  "ref_no string, service_code string, account string, subtotal string, tax string, currency string")
    return P.sales_sheet_normalise(sheet, P.coa_resolver(coa(spark)))


def enriched(spark, *rows):
    chart = coa(spark)
    return L.gl_reporting_enrich(P.sales_invoice_journal(lines(spark, *rows), P.coa_resolver(chart)), chart)


def test_autopost_stops_on_an_unmapped_account(spark):
    ledger = enriched(spark, ("I1", "S1", "Testing", "5"))
    changed = spark.createDataFrame([("I1",), ("I2",)], "ref_no string")
    mixed = lines(spark, ("I1", "S1", "Testing", "100"), ("I1", "S2", "Nowhere", "50"))
    with pytest.raises(ValueError, match="Nowhere"):
        P.sales_detail_autopost(ledger, mixed, changed, coa(spark))


def test_autopost_carries_the_codes(spark):
    ledger = enriched(spark, ("I1", "S1", "Testing", "5"), ("I3", "S1", "Testing", "7"))
    changed = spark.createDataFrame([("I1",), ("I2",)], "ref_no string")
    after = P.sales_detail_autopost(ledger, lines(spark, ("I1", "S1", "Testing", "100")), changed, coa(spark))
    got = {(r.source_line_id, r.debit - r.credit, r.coa_code, r.reporting) for r in after.collect()}
    assert got == {("I1#AR", 100, "1121-11-000", "Balance"), ("I1#S1", -100, "4125-10-000", "Profit"),
                   ("I3#AR", 7, "1121-11-000", "Balance"), ("I3#S1", -7, "4125-10-000", "Profit")}


def test_import_of_a_sheet_without_optional_columns(spark):
    sheet = spark.createDataFrame([("I1", "S1", "Testing", "9")], "ref_no string, service_code string, account string, subtotal string")
    stored = lines(spark, ("I1", "S0", "Testing", "4"), ("I2", "S1", "Testing", "6"))
    other = enriched(spark, ("I2", "S1", "Testing", "6")).selectExpr(
        "* EXCEPT (account_code, type, coa_code)", "CAST(NULL AS STRING) AS account_code", "'other' AS type", "'kept' AS coa_code")
    table, ledger = SP.sales_detail_import(stored, other, sheet, coa(spark), "2026-01-02 03:04:05")
    got = {(r.ref_no, r.service_code): str(r.imported_at) for r in table.collect()}
    assert got == {("I1", "S1"): "2026-01-02 03:04:05", ("I2", "S1"): "None"}
    assert {r.coa_code for r in ledger.filter("type = 'other'").collect()} == {"kept"}


def test_text_after_a_body_is_refused(spark):
    bodies = ['{"data":{"id":"1"}}', '{"data":{"id":"1"}} junk }', '{"data":{"id":"1"}}],[{}', '{"data":{"id":"1"}},{"a":{}}']
    frame = spark.createDataFrame(list(enumerate(bodies)), "callback_id int, body string")
    got = {r.callback_id: r.payload and r.payload.data and r.payload.data.id for r in C.parse_bodies(frame).collect()}
    assert got == {0: "1", 1: None, 2: None, 3: None}


def test_sheet_in_several_files_needs_its_order(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"D{i}") for i in range(8)], "seq long, dept_code string")
    SH.to_headers(rows, "PC").repartition(4).write.option("header", True).csv(str(tmp_path / "a" / "PC"))
    assert [r.dept_code for r in SH.sheet_tables_read(spark, str(tmp_path / "a"), ["PC"])["PC"].orderBy("seq").collect()] == [
        f"D{i}" for i in range(8)]
    SH.to_headers(rows.drop("seq"), "PC").repartition(4).write.option("header", True).csv(str(tmp_path / "b" / "PC"))
    with pytest.raises(ValueError, match="several files"):
        SH.sheet_tables_read(spark, str(tmp_path / "b"), ["PC"])
    with pytest.raises(ValueError, match="no sheet 'COA'"):
        SH.sheet_tables_read(spark, str(tmp_path / "b"), ["COA"])


def test_staff_without_department_counts_nowhere(spark):
    fte = spark.createDataFrame([("D1", 3.0, "x", "x"), (None, 1.0, "x", "x")],
                                "dept string, hc double, location string, location_detail string")
    method = next(m for m, (_, token) in D.K.FTE_SCOPES.items() if token is None)
    roster = spark.createDataFrame([(0, method, "D1")], "seq long, distribution string, new_dept string")
    assert [r.percentage for r in D.fte_factors(fte, roster).collect()] == [1.0]


def test_quantiles_of_a_constant_and_of_many_values(spark):
    frame = spark.sql("SELECT 'c' AS field, 5.0D AS value FROM range(1000) UNION ALL SELECT 'v', CAST(id AS DOUBLE) FROM range(101) "
                      "UNION ALL SELECT 'n', NULL FROM range(3) UNION ALL SELECT 'two', CAST(id AS DOUBLE) FROM range(2)")
    got = {(r.field, r.q): r.quantile for r in exact_quantiles(frame).collect()}
    assert got == {("c", 0.25): 5.0, ("c", 0.5): 5.0, ("c", 0.75): 5.0, ("v", 0.25): 25.0, ("v", 0.5): 50.0, ("v", 0.75): 75.0,
                   ("two", 0.25): 0.25, ("two", 0.5): 0.5, ("two", 0.75): 0.75}


def test_bracketed_quantiles_are_the_exact_ones(spark):
    frame = spark.sql("SELECT 'c' AS field, 5.0D AS value FROM range(1000) UNION ALL SELECT 'n', NULL FROM range(3) "
                      "UNION ALL SELECT 'big', CAST((id * 7919) % 100003 AS DOUBLE) / 7 FROM range(300000) "
                      "UNION ALL SELECT 'ties', CAST(id % 3 AS DOUBLE) FROM range(200000) "
                      "UNION ALL SELECT 'two', CAST(id AS DOUBLE) FROM range(2)")
    want = {(r.field, r.q): r.quantile for r in exact_quantiles(frame).collect()}
    # Small brackets and a coarse sketch force rounds of narrowing.
    for rows in (1_000_000, 10):
        got = bracketed_quantiles(frame, (0.0, 0.25, 0.5, 0.75, 1.0), accuracy=1000, grid=100, exact_rows=rows)
        got = {(r.field, r.q): r.quantile for r in got.collect()}
        assert {k: v for k, v in got.items() if k[1] in (0.25, 0.5, 0.75)} == want
        assert got[("big", 0.0)] == 0.0 and got[("ties", 1.0)] == 2.0
    assert bracketed_quantiles(frame.limit(0)).count() == 0


def test_a_batch_leaves_other_buckets_alone(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "source_id string, n int"
    frame = lambda *rows: spark.createDataFrame(rows, schema)
    files = lambda: {p.parent.name: hashlib.md5(p.read_bytes()).hexdigest() for p in Path(path).glob("*/*.parquet")}
    TB.create_buckets(spark, path, schema)
    TB.create_buckets(spark, path, schema)
    TB.upsert_buckets(spark, path, frame(*[(f"d{i}", i) for i in range(40)]), ["source_id"], 8)
    before = files()
    for _ in range(2):
        TB.upsert_buckets(spark, path, frame(("d3", -3)), ["source_id"], 8)
        assert {r.source_id: r.n for r in TB.read_buckets(spark, path, schema).collect()} == {
            **{f"d{i}": i for i in range(40)}, "d3": -3}
    changed = {b for b, h in files().items() if before[b] != h}
    assert len(changed) == 1
    TB.merge_buckets(spark, path, frame(*[(f"d{i}", 0) for i in range(40)]), lambda stored: stored.limit(0), 8, "source_id", schema)
    assert TB.read_buckets(spark, path, schema).count() == 0


def test_partitions_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """A task keeps the files of its buckets open; with fewer open ones the rows are the same."""
    schema, key, seen = "source_id string, n int", "spark.sql.maxConcurrentOutputFileWriters", []
    rows = spark.createDataFrame([*[(f"d{i}", i) for i in range(100)], (None, -1), ("d3", 3)], schema)
    write, given = DataFrameWriter.parquet, spark.conf.get(key)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (seen.append(int(self._spark.conf.get(key))), write(self, *a, **k))[1])
    for files in (TB.OPEN_FILES, 2):
        monkeypatch.setattr(TB, "OPEN_FILES", files)
        path = str(tmp_path / f"t{files}")
        TB.create_buckets(spark, path, schema)
        TB.replace_partitions(TB.bucketed(rows, 8), path, [TB.BUCKET])
        assert seen[-1] == files and spark.conf.get(key) == given
        assert sorted(map(str, TB.read_buckets(spark, path, schema).collect())) == sorted(map(str, rows.collect()))
        for bucket in Path(path).glob(f"{TB.BUCKET}=*"):
            assert {r[0] for r in TB.bucketed(spark.read.schema(schema).parquet(str(bucket)), 8).select(TB.BUCKET).distinct().collect()} <= {
                int(bucket.name.split("=")[1])}


def test_many_changed_invoices_leave_the_ledger_unsorted(spark, monkeypatch):
    ledger = enriched(spark, ("I1", "S1", "Testing", "5"), ("I3", "S1", "Testing", "7"), ("I4", "S1", "Testing", "8"))
    ledger = ledger.unionByName(ledger.filter("source_line_id = 'I4#AR'").withColumn("source_id", F.lit(None).cast("string")))
    changed = spark.createDataFrame([("I1",), ("I1",), ("I3",), (None,)], "ref_no string")
    now = lines(spark, ("I1", "S1", "Testing", "100"))
    few = P.sales_detail_autopost(ledger, now, changed, coa(spark))
    monkeypatch.setattr(P, "MANY_REFS", 2)
    many = P.sales_detail_autopost(ledger, now, changed, coa(spark))
    assert "ShuffledHashJoin" in many._jdf.queryExecution().sparkPlan().toString()
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect())) and many.count() == 5


def test_the_drifted_ledger_is_made_from_one_journal(spark):
    journal = spark.createDataFrame([(f"INV{k}", f"INV{k}", f"INV{k}", f"INV{k}{e}", 5) for k in range(1, 5) for e in ("#AR", "#S1")] + [(None,) * 5],
                                    "ref_no string, source_id string, ref_key string, source_line_id string, debit int")
    drifted = SQ._posted(journal)
    assert "Union" not in drifted._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.ref_no, r.source_id, r.ref_key, r.source_line_id, int(r.debit)) for r in drifted.collect()) == sorted(
        (n, n, n, n + e, 6 if (n, e) == ("INV1", "#AR") else 5) for n in ("INV1", "INV3", "INV4", "XINV3") for e in ("#AR", "#S1"))


def month(spark, *rows):
    return spark.createDataFrame([(a, b, "D1", "Old", "5111-11-000", "Travel", "Profit & Loss", "approved", 5, 0) for a, b in rows],
                                 "ref_no string, date string, dept_code string, department string, coa_code string, coa_name string, "
                                 "reporting string, status string, debit int, credit int").selectExpr(
        "* EXCEPT (date)", "CAST(date AS DATE) AS date", "'t' AS type", "'c' AS contact", "'d' AS description", "'n' AS note",
        "'p' AS project", "'IDR' AS currency")


def test_month_import_replaces_reports_and_refuses(spark):
    ledger = month(spark, ("A", "2026-01-05"), ("B", "2026-02-01")).withColumn("reporting", D.F.lit(D.K.LEDGER_REPORTING_GROUP)).withColumn(
        "status", D.F.lit(D.K.LEDGER_STATUSES[0])).withColumn("coa_code", D.F.concat(D.F.lit(D.K.LEDGER_PREFIXES[0]), D.F.lit("00")))
    master = spark.createDataFrame([("D1", "New")], "dept_code string, dept_name string")
    locks = spark.sql("SELECT DATE'2026-02-01' AS period, 'closed' AS status")
    empty = D.gl_import_from_ledger(ledger.limit(0), master, "2026-01-01")
    first, report = R.import_month(ledger, master, empty, "2026-01-01", locks)
    assert [(r.ref_no, r.dept) for r in first.collect()] == [("A", "New")]
    assert tuple(report.first()) == (1, 1, 1, 0)
    again, _ = R.import_month(ledger, master, first, "2026-01-01", locks)
    assert again.count() == 1
    with pytest.raises(ValueError, match="no row to import"):
        R.import_month(ledger, master, first, "2026-03-01", locks)
    for write in (lambda: R.import_month(ledger, master, first, "2026-02-01", locks),
                  lambda: SH.basis_seed({}, {}, "2026-02-01", locks=locks),
                  lambda: SH.allocation_persist(first, first, "2026-02-01", locks),
                  lambda: SH.gl_entry_seed_sheet(first, first, "2026-02-01", locks)):
        with pytest.raises(PermissionError, match="closed"):
            write()
    with pytest.raises(ValueError, match="no ledger line"):
        SH.gl_entry_read(first, "2026-05-01")
    with pytest.raises(ValueError, match="no ledger line"):
        SH.gl_entry_seed_sheet(first.drop("period"), first, "2026-05-01")


def test_summary_has_its_load_time(spark):
    sales = spark.sql("SELECT 1 AS transaction_id, 100.0D AS total_amount, TIMESTAMP'2026-01-02 10:00:00' AS created_at, 'completed' AS status")
    rows = V.transform(sales, "2026-01-03 00:00:00").collect()
    assert len(rows) == 3 and {str(r.etl_loaded_at) for r in rows} == {"2026-01-03 00:00:00"}
