"""Every registered query against its SQL in DuckDB, over the smallest tables."""

import decimal

import duckdb
import pytest

from fleetmetrics.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return f"{value:.5g}"
    return str(value.normalize()) if isinstance(value, decimal.Decimal) else str(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([plain(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(name, spark, duck):
    df = registry.queries()[name](spark, SF)
    got = table(df.columns, df.collect())
    if name not in registry.oracle_sql():
        assert got[1]
        return
    found = duck.sql(registry.oracle_sql()[name])
    assert got == table(list(found.columns), found.fetchall())
