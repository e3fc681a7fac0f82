"""Flattening finds its columns in the bodies."""

import json

from saldoflow.operators import profiling as P
from tests.test_journals import feed


def test_a_field_only_one_body_has_is_a_column(spark):
    a = {"end_point": "sales_invoices", "method": "POST",
         "data": {"id": "A", "status": "draft", "supplier": {"name": "PT A"}, "lines": [1, 2]}}
    b = {"end_point": "bank_transfers", "method": "PUT",
         "data": {"id": "B", "rare": {"deep": {"x": 7}}, "method": "PATCH"}}
    mixed = {"end_point": "x", "method": "POST", "data": {"id": "C", "status": 3}}
    flat = P.callback_flatten(feed(spark, a, json.dumps(json.dumps(b)), mixed, "not json", None, "[1]"))
    rows = {r.callback_id: r.asDict() for r in flat.collect()}
    assert "rare.deep.x" in flat.columns and "supplier.name" in flat.columns
    assert rows[2]["rare.deep.x"] == 7 and rows[1]["rare.deep.x"] is None
    assert rows[1]["supplier.name"] == "PT A" and rows[1]["end_point"] == "sales_invoices"
    # A data field wins over the top-level one; a body encoded twice is decoded.
    assert rows[2]["method"] == "PATCH" and rows[2]["end_point"] == "bank_transfers"
    # Types that differ between bodies stay as JSON text.
    assert rows[1]["status"] == '"draft"' and rows[3]["status"] == "3"
    for k in (4, 5, 6):
        assert rows[k]["id"] is None and rows[k]["end_point"] is None
    # The fixed preview fields are there even when no body has them.
    assert {"currency.code", "project.name", "payment_status"} <= set(flat.columns)


def test_empty_feed_has_the_base_columns(spark):
    flat = P.callback_flatten(feed(spark))
    assert flat.count() == 0 and set(P.BASE_COLUMNS) <= set(flat.columns)


def test_frontier_is_observed_on_the_extracting_scan(spark):
    from datetime import datetime

    from saldoflow.sources import callbacks as C
    body = {"end_point": "sales_invoices", "method": "POST", "data": {"id": "A", "status": "approved"}}
    times = {0: datetime(2026, 1, 1), 1: datetime(2026, 1, 3), 2: datetime(2026, 1, 2)}
    rows, seen = C.observed_extract(feed(spark, body, "garbage", body, times=times))
    assert rows.count() == 2
    # The newest row is not parseable and still moves the frontier.
    assert C.observed_frontier(spark, seen).head().frontier == datetime(2026, 1, 3)
    none, seen = C.observed_extract(feed(spark, body), since=datetime(2027, 1, 1))
    assert none.count() == 0 and C.observed_frontier(spark, seen).head().frontier is None
