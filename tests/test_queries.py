"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from cobasket.plans import catalog, oracles
from tools.check import rows_of

QUERIES, ORACLES = catalog.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def database(small):
    connection = duckdb.connect()
    for path in Path(small).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= registry.queries().keys() and ORACLES.keys() <= registry.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, small, database, name):
    df = QUERIES[name](spark, small)
    result = database.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert registry.entry(spark).limit(1).count() == 1
