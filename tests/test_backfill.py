"""Backfill over several stored tables: one pass, only the buckets with changes rewritten."""

import hashlib
from pathlib import Path

from saldoflow.operators import backfill as B
from saldoflow.sources import tables as TB

SCHEMA = "source_id string, source_line_id string, department string, dept_code string, id long"


def test_run_over_tables_rewrites_changed_buckets_only(spark, tmp_path):
    by_line = spark.createDataFrame([("D1", "L1", "C1")], "source_id string, line_id string, dept_code string")
    by_document = spark.createDataFrame([("D1", "H1", "Head")], "source_id string, dept_code string, department string")
    rows = {"gl": [("D1", "L1", "x", None, 1), ("D2", "L9", "x", "OLD", 2)] + [(f"Q{i}", "L", "x", "K", 10 + i) for i in range(40)],
            "cash_in": [("D9", "L9", "x", "KEEP", 3)], "empty": []}
    folder = str(tmp_path)
    for n, r in rows.items():
        TB.replace_partitions(TB.bucketed(spark.createDataFrame(r, SCHEMA), B.BUCKETS), f"{folder}/{n}", [TB.BUCKET])
        TB.create_buckets(spark, f"{folder}/{n}", SCHEMA)
    files = lambda n: {p.parent.name: hashlib.md5(p.read_bytes()).hexdigest() for p in Path(folder, n).glob("*/*.parquet")}
    before = files("gl")
    changes = B.backfill_run(spark, folder, list(rows), {n: SCHEMA for n in rows}, by_line, by_document, recheck=True)
    assert sorted((r.table_name, r.id, r.old_code, r.new_code) for r in changes.collect()) == [
        ("gl", 1, None, "C1"), ("gl", 2, "OLD", None)] + sorted(("gl", 10 + i, "K", None) for i in range(40))
    got = {r.id: r.dept_code for n in rows for r in TB.read_buckets(spark, f"{folder}/{n}", SCHEMA).collect()}
    assert got[1] == "C1" and got[2] is None and got[3] == "KEEP"  # cash_in resolves nothing: its codes stay
    after = files("gl")
    assert len(after) == len(before) and sum(after[b] != before[b] for b in after) >= 1
    # A second run finds nothing and rewrites nothing.
    assert B.backfill_run(spark, folder, list(rows), {n: SCHEMA for n in rows}, by_line, by_document, recheck=True).count() == 0
    assert files("gl") == after
