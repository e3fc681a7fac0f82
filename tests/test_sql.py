"""All queries against the same question in SQL, on the smallest given tables."""

import decimal
import os
from pathlib import Path

import duckdb
import pytest

from saldoflow import catalog

FOLDER = os.environ.get("SALDOFLOW_SF_DIR", "/root/testdata/sf0.001")
catalog.load_all()
NAMES = sorted(catalog.ORACLES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    return str(v) if isinstance(v, decimal.Decimal) or v is not None else None


def rows(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables are not here")
@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, FOLDER)
    want = duck.execute(catalog.ORACLES[name])
    names = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, want.fetchall())


def test_every_query_has_sql():
    assert set(catalog.ORACLES) == set(catalog.QUERIES)
