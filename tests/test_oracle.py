"""Every registered query against its SQL, on the smallest test data."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def normal(row):
    return tuple("" if v is None else str(v) for v in row)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    result = duck.sql(contract.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(result.columns)
    found = sorted(normal(r) for r in df.select(columns).collect())
    wanted = sorted(normal(r) for r in result.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert len(found) == len(wanted) and len(found) > 0
    assert found == wanted
    types = dict(zip(result.columns, result.types))
    for field in df.schema.fields:
        assert str(types[field.name]).split("(")[0] == {
            "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
            "date": "DATE", "timestamp_ntz": "TIMESTAMP",
        }.get(field.dataType.simpleString(), "DECIMAL"), field
