"""Hand-checked distribution, sales detail, department and backfill cases."""

from datetime import date
from decimal import Decimal

import pytest

from saldoflow.operators import backfill as B, departments as DP, distribution as D, sales_detail as P
from saldoflow.operators.ordering import global_position
from saldoflow.plans import distribution_run as R, sales_posting as SP

ADMIN = "Administration Indonesia"
GL = ("seq bigint, date date, type string, ref_no string, dept_code string, dept string, debit double, "
      "credit double, account_code string, account_name string")


def sheets(spark, receivers=("Rev One", "Rev Two"), logic=(), extra=()):
    pc = [("A1", "Admin One", "Admin One", ADMIN, 0), ("A2", "Admin Two", "Admin Two", ADMIN, 1)]
    pc += [(f"R{i}", r, r, "Revenue", 2 + i) for i, r in enumerate(receivers)]
    share = 1 / (2 + len(receivers))
    alloc = [("FTE - All", None, d, share, i) for i, d in enumerate(["Admin One", "Admin Two", *receivers])]
    return {
        "PC": spark.createDataFrame(pc, "dept_code string, dept string, div string, pc string, seq bigint"),
        "COA": spark.createDataFrame([("6101-00-000", "Salary", "200", "Wages", "200 Wages", 0),
                                      ("7501-00-000", "Allocation Overhead", "360", "Overhead", "360 Overhead", 1)],
                                     "code string, account_name string, reporting_code string, reporting_line string, reporting_account string, seq bigint"),
        "LOGIC": spark.createDataFrame(list(logic), "account_code string, account_name string, pc string, distribution string, code string"),
        "ALLOCATION": spark.createDataFrame(alloc + list(extra), "distribution string, account_name string, new_dept string, percentage double, seq bigint")}


def gl(spark, *lines):
    rows = [(i, date(2026, 7, 5), "GJ", f"R{i}", *line) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, GL).selectExpr("*", "seq AS gl_line_id")


def swept(run):
    return sorted((r.new_dept, round(r.allocation, 6)) for r in run.overhead.collect())


COST = ("A1", "Admin One", 100.0, 0.0, "6101-00-000", "Salary")


def test_sweep_moves_cost_to_receivers(spark):
    run = R.distribute(gl(spark, COST, ("R0", "Rev One", 50.0, 0.0, "6101-00-000", "Salary")), sheets(spark))
    assert swept(run) == [("Admin One", -100), ("Rev One", 50), ("Rev Two", 50)]
    row = run.overhead.head()
    assert row.description == "Allocation Overhead 0726" and row.method == "FTE : PC Juni"
    recon = R.validate(run).head()
    assert (recon.n_direct, recon.n_overhead, recon.overhead_pool, recon.variance) == (2, 3, 100.0, 0.0)


@pytest.mark.parametrize("revenue,expected", [(30.0, [("Admin One", -70), ("Rev One", 35), ("Rev Two", 35)]),
                                              (250.0, [("Admin One", 150), ("Rev One", -75), ("Rev Two", -75)])])
def test_administrative_revenue_settles_own_cost(spark, revenue, expected):
    run = R.distribute(gl(spark, COST, ("A1", "Admin One", 0.0, revenue, "4101-00-000", "Sales")), sheets(spark))
    assert swept(run) == expected


def test_weights_take_the_rounding_gap(spark):
    lk = R.build_lookups(sheets(spark, ("Rev One", "Rev Two", "Rev Three")))
    w = {r.new_dept: round(r.weight, 6) for r in D.overhead_weights(lk.split, lk.swept).collect()}
    assert w == {"Rev One": 0.3334, "Rev Two": 0.3333, "Rev Three": 0.3333}


def test_stale_name_follows_the_code(spark):
    run = R.distribute(gl(spark, ("R0", "Former name", 5.0, 0.0, "6101-00-000", "Salary")), sheets(spark), overhead=False)
    row = run.base.head()
    assert (row.new_dept, row.pc, row.new_dept_code) == ("Rev One", "Revenue", "R0")


def test_missing_bucket_matches_rule_without_bucket(spark):
    s = sheets(spark, logic=[("6101-00-000", "salary", None, "FTE - All", None)])
    run = R.distribute(gl(spark, (None, "Nobody", 8.0, 0.0, "6101-00-000", "SALARY")), s, overhead=False)
    assert sorted(r.allocation for r in run.base.collect()) == [2.0] * 4


def test_gates_stop_a_run(spark):
    s = sheets(spark, logic=[("6101-00-000", "Salary", ADMIN, "Unknown", None)])
    run = R.distribute(gl(spark, COST), s)
    assert run.rejects.count() == 1
    with pytest.raises(ValueError, match="no_rejects"):
        R.validate(run)
    half = sheets(spark, logic=[("6101-00-000", "Salary", ADMIN, "Half", None)], extra=[("Half", None, "Rev One", 0.5, 9)])
    with pytest.raises(ValueError, match="line_conservation"):
        R.validate(R.distribute(gl(spark, COST), half))
    double = sheets(spark, logic=[("6101", "a", "b", "x", None), ("6101", " A ", "B", "y", None)])
    with pytest.raises(ValueError, match="ambiguous"):
        R.build_lookups(double)


def test_headcount_factors_and_drift(spark):
    fte = spark.createDataFrame([("D1", 3.0, "Surabaya office", None), ("D2", 1.0, "surabaya", None), ("D3", 9.0, "Medan", None)],
                                "dept string, hc double, location string, location_detail string")
    alloc = spark.createDataFrame([("FTE - Surabaya", None, d, 0.5, i) for i, d in enumerate(("D1", "D2", "D3"))],
                                  "distribution string, account_name string, new_dept string, percentage double, seq bigint")
    assert {r.new_dept: r.percentage for r in D.fte_factors(fte, alloc).collect()} == {"D1": 0.75, "D2": 0.25, "D3": 0.0}
    rev = spark.createDataFrame([], "div string, pct_ho double, pct_all double, pct_certification_services double")
    two = alloc.filter("new_dept <> 'D3'")
    drift = D.basis_drift(D.allocation_recompute(two, fte, rev), two).head()
    assert (drift.max_drift, drift.in_sync, drift.sum_stored) == (0.25, False, 1.0)


def test_period_lock_refuses(spark):
    locks = spark.createDataFrame([], "period date, status string, closed_at timestamp_ntz, note string")
    locks = D.period_close(locks, "2026-07-01", "2026-08-01 00:00:00", "n")
    run = R.distribute(gl(spark, COST), sheets(spark))
    stored = D.distribution_stored(run.out, 1).limit(0)
    with pytest.raises(PermissionError, match="2026-07-01"):
        R.snapshot_replace(stored, run, run.recon, locks, 2)
    reopened, existed = D.period_reopen(locks, "2026-07-01")
    assert existed.head().existed and reopened.count() == 0
    rows, row = R.snapshot_replace(stored, run, run.recon, reopened, 2)
    assert rows.count() == 4 and row.head().period == date(2026, 7, 1)


def test_positions_are_dense_whatever_the_partitions(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("(id * 7919) % 1000 AS v")
    got = global_position(df, ["v"], "pos").collect()
    assert all(r.v == r.pos for r in got) and len(got) == 1000


COA = [(0, "1121-11-000", "AR", "B"), (1, "1121-12-000", "AR foreign", "B"), (2, "2124-11-000", "VAT", "B"), (3, "4125-10-000", "Testing", "P")]
SD = ("ref_no string, service_code string, date date, contact string, dept_code string, dept string, description string, service string, "
      "account string, subtotal decimal(18,2), tax decimal(18,2), total decimal(18,2), currency string, exchange_rate decimal(18,6), "
      "status string, created_at timestamp_ntz")


def sales(spark, *lines):
    rows = [(r, c, date(2026, 7, 1), "x", "D", "Dept", "d", "s", a, Decimal(s), Decimal(t), Decimal(s) + Decimal(t), cur, Decimal(1),
             "approved", None) for r, c, a, s, t, cur in lines]
    return spark.createDataFrame(rows, SD), spark.createDataFrame(COA, "seq bigint, account_code string, account_name string, reporting string")


def test_sales_invoice_entry(spark):
    lines, coa = sales(spark, ("I1", "S1", "Testing", "2178000", "239580", "IDR"), ("C1", "S1", "Testing", "-9018500", "-992035", "USD"))
    j = P.guarded_journal(lines, P.coa_resolver(coa))
    got = {(r.source_line_id, r.account_code): (r.debit, r.credit) for r in j.collect()}
    assert got[("I1#AR", "112111")] == (2417580, 0) and got[("I1#S1", "41251")] == (0, 2178000)
    assert got[("I1#VAT", "212411")] == (0, 239580) and got[("C1#AR", "112112")] == (-10010535, 0)
    bad, _ = sales(spark, ("I2", "S", "Nowhere", "1", "0", "IDR"))
    with pytest.raises(ValueError, match="Nowhere"):
        P.guarded_journal(bad, P.coa_resolver(coa))


def test_department_merge(spark):
    stamp = "TIMESTAMP_NTZ '2020-01-01'"
    master = spark.sql(f"SELECT 'D013' AS dept_code, 'Old' AS dept_name, {stamp} AS created_at, {stamp} AS updated_at")
    listing = spark.createDataFrame([("A00", "Head"), ("D041", "Lab")], "dept_code string, dept_name string")
    merged = {r.dept_code for r in DP.department_upsert(master, listing, "2026-01-01 00:00:00").collect()}
    assert merged == {"D013", "A00", "D041"}
    assert [r.dept_code for r in DP.department_surplus(master, listing).collect()] == ["D013"]
    pruned = DP.department_upsert(master, listing, "2026-01-01 00:00:00", prune=True)
    assert {r.dept_code for r in pruned.collect()} == {"A00", "D041"}


def test_code_resolution(spark):
    rows = spark.createDataFrame([(1, "DOC-1", "LINE-1", "x"), (2, "DOC-1", "LINE-1_TAX-9_tax", "x"), (3, "DOC-1", "L9", "head  quarter"),
                                  (4, "DOC-1", "L9", "CTS"), (5, "NOPE", "L9", "Head Quarter")],
                                 "id int, source_id string, source_line_id string, department string")
    by_line = spark.createDataFrame([("DOC-1", "LINE-1", "D041")], "source_id string, line_id string, dept_code string")
    by_doc = spark.createDataFrame([("DOC-1", "A00", "Head Quarter")], "source_id string, dept_code string, department string")
    got = {r.id: r.resolved_code for r in B.code_resolve(rows, by_line, by_doc).collect()}
    assert got == {1: "D041", 2: "D041", 3: "A00", 4: None, 5: None}
    table = rows.selectExpr("*", "'gl' AS table_name", "'ZZ' AS dept_code")
    again = {r.id: r.new_code for r in B.code_backfill(table, by_line, by_doc, recheck=True).collect()}
    assert again[4] is None and again[1] == "D041"
    none = B.code_backfill(table.filter("id > 3"), by_line, by_doc, recheck=True)
    assert {r.new_code for r in none.collect()} == {"ZZ"}      # nothing resolved, nothing cleared
