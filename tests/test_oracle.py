"""Every registered query against its SQL equivalent in another engine."""

import datetime
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from incidentlens.plans import oracle, queries

TABLES = ("orders", "customer", "nation", "supplier")
SPARK_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def engine(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    yield connection
    connection.close()


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def plain(value):
        return value.isoformat() if isinstance(value, datetime.date) else value
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, engine, sf_dir, name):
    result = entry_module.queries()[name](spark, sf_dir)
    expected = engine.execute(entry_module.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in expected.description}
    assert {c: SPARK_TYPES[t] for c, t in result.dtypes} == types
    ours = as_bag(result.columns, [tuple(row) for row in result.collect()])
    theirs = as_bag([c[0] for c in expected.description], expected.fetchall())
    assert ours, "an empty result proves nothing"
    assert ours == theirs


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())


def test_entry_has_ten_rows(spark):
    assert entry_module.entry(spark).count() == 10
