"""Every registered query against its SQL on the small tables."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as registered
from snapline.catalog import analysis, builds  # noqa: F401
from snapline.catalog.registry import QUERIES, SQL
from snapline.sources.tables import TABLES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return str(value)


def _table(columns, rows):
    places = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(_plain(row[i]) for i in places) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    result = db.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert _table(df.columns, df.collect()) == _table(columns, result.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) <= set(registered.queries())


def test_entry(spark):
    df = registered.entry(spark)
    assert len(df.columns) == 24 and df.count() > 0
