"""Plans that must not depend on how small Spark takes a table to be, on tables made here."""

from pathlib import Path

import pytest

from saldoflow.catalog import feed_queries, inputs, ledger_queries, sales_queries, scalar_queries, table_queries
from saldoflow.operators import backfill as B, documents as D, ledger as L
from saldoflow.plans import callback_run as R
from saldoflow.session import shared_folder
from saldoflow.sources import callbacks as C, tables as TB

DOCUMENT = ("callback_id long, document struct<id: string, department: struct<id: string, code: string, name: string>, "
            "line_items: array<struct<id: string, department: struct<id: string, code: string, name: string>>>>")


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    spark.sql("SELECT 0L AS r_regionkey, 'ASIA' AS r_name").write.parquet(f"{out}/region.parquet")
    spark.sql("SELECT id AS n_nationkey, concat('N', id) AS n_name, 0L AS n_regionkey FROM range(3)").write.parquet(f"{out}/nation.parquet")
    spark.sql("SELECT id AS c_custkey, concat('C', id) AS c_name, id % 3 AS c_nationkey, 'BUILDING' AS c_mktsegment FROM range(30)").repartition(
        3).write.parquet(f"{out}/customer.parquet")
    spark.sql("SELECT id AS s_suppkey, id % 3 AS s_nationkey FROM range(6)").write.parquet(f"{out}/supplier.parquet")
    spark.sql("SELECT id AS p_partkey, concat('T', id) AS p_type, 1 AS p_size FROM range(4)").write.parquet(f"{out}/part.parquet")
    spark.sql("SELECT id AS o_orderkey, id % 30 AS o_custkey, 'O' AS o_orderstatus, '1-URGENT' AS o_orderpriority, "
              "TIMESTAMP_NTZ '1997-01-02 00:00:00' AS o_orderdate, 10.0D AS o_totalprice FROM range(200)").write.parquet(f"{out}/orders.parquet")
    spark.sql("SELECT o.id AS l_orderkey, n.id AS l_linenumber, 1L AS l_suppkey, 1L AS l_partkey, 10.0D AS l_extendedprice, "
              "0.1D AS l_discount, 0.1D AS l_tax FROM range(200) o, range(1, 3) n").write.parquet(f"{out}/lineitem.parquet")
    return out


def test_orders_meet_their_lines_by_a_shuffle(spark, folder, capsys):
    orders = inputs.orders_with_lines(spark, folder)
    assert "SortMergeJoin [k#" in plan(orders, capsys)
    assert sorted((r.k, len(r.ls)) for r in orders.select("k", "ls").collect()) == [(k, 2) for k in range(200)]


def test_more_orders_are_more_pieces(spark, folder, monkeypatch):
    monkeypatch.setattr(inputs, "ORDERS_A_PIECE", 10)
    feed = inputs.callbacks(spark, folder, "cash_in")
    assert feed.rdd.getNumPartitions() == 20 and feed.count() == 200


def test_a_larger_feed_has_more_pieces(spark, folder, monkeypatch):
    monkeypatch.setattr(inputs, "ORDERS_A_PIECE", 10)
    rows = feed_queries.feed(spark, folder)
    assert rows.rdd.getNumPartitions() == 20
    assert rows.count() == sum(1 + (k % 3 == 0) + (k % 7 == 0) + (k % 11 == 0) for k in range(200))


def test_newest_versions_are_not_broadcast(spark, capsys):
    lines = spark.sql("SELECT * FROM VALUES ('m', 'A', 1, TIMESTAMP_NTZ '2024-01-01 00:00:00'), ('m', 'A', 2, TIMESTAMP_NTZ '2024-01-02 00:00:00'), "
                      "('m', 'A', 3, TIMESTAMP_NTZ '2024-01-02 00:00:00'), (NULL, 'B', 4, NULL), ('m', 'B', 5, NULL) "
                      "AS t(module, source_id, n, raw_created_at)")
    kept = L.latest_version_rows(lines)
    assert "Broadcast" not in plan(kept, capsys)
    assert sorted(r.n for r in kept.collect()) == [2, 3, 4, 5]


def test_backfill_lookups_are_read_not_parsed_again(spark, capsys):
    code = lambda c: (None, c, "Head")
    documents = spark.createDataFrame([
        (1, ("D1", code("H1"), [("L1", code("A")), ("L2", None)])), (2, ("D1", code("H2"), [("L1", code("B"))])),
        (3, ("", code("H9"), []))], DOCUMENT)
    by_line, by_document = B.code_backfill_lookup(documents)
    assert sorted(map(tuple, by_line.collect())) == [("D1", "L1", "B"), ("D1", "L2", "H1")]
    assert [tuple(r) for r in by_document.collect()] == [("D1", "H2", "Head")]
    for lookup in (by_line, by_document):
        text = plan(lookup, capsys)
        assert "FileScan parquet" in text and "Aggregate" not in text


def test_sheets_written_in_several_files_can_be_read(spark, folder):
    got = {r.sheet: r.n for r in table_queries.sheet_tables_read(spark, folder).collect()}
    assert got["FTE"] == 30 and got["REV"] == 6


def test_a_run_decides_once_which_versions_load(spark, folder, capsys):
    """The subledger of a module reads what was decided, and only its own documents."""
    feed = ledger_queries.nine_kinds(spark, folder).filter("callback_id < 16 * 20")
    load = R.module_process(C.route(feed))
    text = plan(load.lines.filter("module = 'cash_in'"), capsys)
    found = [line for line in text.splitlines() if "PartitionFilters: [" in line]
    assert "Aggregate" not in text and len(found) == 2 and all(" = cash_in)" in line for line in found), text
    assert {r.module for r in load.lines.select("module").distinct().collect()} >= {"cash_in", "cash_out", "manual_journal"}


def test_columns_of_a_document_that_nobody_reads_are_not_worked_out(spark, folder, capsys):
    text = plan(scalar_queries.purchase_reference_pick(spark, folder), capsys)
    assert "AS claims" in text and "draft_rows" not in text and "AS error" not in text, text
    base = spark.sql("SELECT 2 AS a")
    both = D.once(D.once(base, b="a + 1", c="a + 2"), d="b + b")
    assert "c#" not in plan(both.select("d"), capsys) and both.head().asDict() == {"a": 2, "b": 3, "c": 4, "d": 6}


@pytest.mark.parametrize("name", ["sales_detail_repost", "sales_detail_autopost"])
def test_stored_lines_are_read_not_joined_again(spark, folder, capsys, monkeypatch, name):
    monkeypatch.setattr(sales_queries.P, "MANY_REFS", 1)
    df = getattr(sales_queries, name)(spark, folder)
    text = plan(df, capsys)
    assert "/lineitem.parquet" not in text, text
    assert "ShuffledHashJoin [source_id#" in text, text
    # 200 invoices: a receivable, two lines and a tax row, if any; a fifth have none.
    if name == "sales_detail_repost":
        assert df.count() == 200 * 3 + 160


def test_merged_buckets_leave_nothing_behind(spark, tmp_path):
    rows = lambda text: spark.createDataFrame(text, "source_id string, v int")
    path, before = str(tmp_path / "t"), set(Path(shared_folder(spark).removeprefix("file:")).glob("buckets-*"))
    TB.create_buckets(spark, path, rows([]).schema)
    for new in ([("a", 1), ("b", 1), ("c", 1)], [("b", 2)]):
        TB.upsert_buckets(spark, path, rows(new), ["source_id"], 4)
    assert sorted(tuple(r) for r in TB.read_buckets(spark, path, rows([]).schema).collect()) == [("a", 1), ("b", 2), ("c", 1)]
    assert set(Path(shared_folder(spark).removeprefix("file:")).glob("buckets-*")) == before
