"""The queries that SQL can express against that SQL in another engine."""

from collections import Counter

import duckdb
import pytest

from incidentlens.llm import oracle, queries

TABLES = ("documents", "benchmark", "pages")


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, name, folder):
    with duckdb.connect() as engine:
        for table in TABLES:
            engine.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
        cursor = engine.execute(oracle.oracle_sql()[name])
        columns = [c[0] for c in cursor.description]
        expected = Counter(cursor.fetchall())
    found = Counter(tuple(r) for r in queries.queries()[name](spark, folder).select(*columns).collect())
    assert found and found == expected
