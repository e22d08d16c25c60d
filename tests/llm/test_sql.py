"""Queries that SQL can express, against their SQL."""

import duckdb
import pytest

from hourstar.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    result = connection.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(result.columns)
    wanted = result.select(*[duckdb.ColumnExpression(c) for c in df.columns]).fetchall()
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, wanted))
    assert wanted
