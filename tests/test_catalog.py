"""Every payables query against its SQL in DuckDB, on the smallest tables."""

import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from payloom.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
SQL = catalog.oracle_sql()


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if isinstance(x, Decimal):
            return f"{x:f}"
        if isinstance(x, (date, datetime)):
            return str(x)[:10]
        return x

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_all_have_sql():
    assert set(SQL) == set(catalog.queries())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    want = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert plain(df.collect(), df.columns) == plain(want.fetchall(), want.columns)
