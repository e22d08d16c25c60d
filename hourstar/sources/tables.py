"""Parquet sinks and typed catalog tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hourstar import schemas

MAX_RECORDS_PER_FILE = 3_000_000


def write_table(df: DataFrame, path: str, compact: bool = False, max_records: int = MAX_RECORDS_PER_FILE,
                observe: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Overwrite a Parquet folder.

    ``compact`` lets AQE size the partitions: a small table becomes one file, and one that has grown
    becomes several, where a fixed single partition would not scale. ``observe`` is put last, behind that exchange.
    """
    out = df.hint("rebalance") if compact else df
    out = observe(out) if observe else out
    out.write.mode("overwrite").option("maxRecordsPerFile", max_records).parquet(path)


def write_split(df: DataFrame, path: str, by: str, order: Sequence[str] = (), max_records: int = MAX_RECORDS_PER_FILE,
                observe: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Overwrite a Parquet folder that has a subfolder per value of ``by``, so that joins and filters on it choose files.

    One exchange brings a value's rows together. AQE cuts a value of many rows over several tasks and lets one task write
    several values of few; nothing is sampled, so the plan runs once. Rows of a file follow ``order``. Nulls come back as
    nulls; an empty text, whose folder would be that of the nulls, stops the write.
    """
    column = F.col(by)
    if isinstance(df.schema[by].dataType, StringType):
        column = F.when(column == "", F.raise_error(F.lit(f"{by} must not be empty"))).otherwise(column)
    out = df.withColumn(by, column).hint("rebalance", by).sortWithinPartitions(by, *order)
    out = observe(out) if observe else out
    out.write.mode("overwrite").option("maxRecordsPerFile", max_records).partitionBy(by).parquet(path)


def read_table(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """Read a Parquet folder's part files with an explicit schema."""
    return spark.read.schema(schemas.read_ddl(columns)).option("pathGlobFilter", "part-*").parquet(path)


def recreate_table(spark: SparkSession, name: str, columns: Mapping[str, str], location: str) -> None:
    """Drop a typed external Parquet table and create it without rows.

    Dropping an external table keeps its files, so what lies at the location is overwritten.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({schemas.columns_ddl(columns)}) USING parquet LOCATION '{location}'")
    spark.createDataFrame([], spark.table(name).schema).write.insertInto(name, overwrite=True)


def point_view(spark: SparkSession, name: str, columns: Mapping[str, str], location: str) -> None:
    """Let a catalog name stand for the Parquet folder at ``location``, in one step."""
    names = ", ".join(f"CAST(`{c}` AS {schemas.simple_type(t)}) AS `{c}`" for c, t in columns.items())
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {names} FROM parquet.`{location}`")


def setup_star(spark: SparkSession, database: str, location: str,
               tables: Mapping[str, Mapping[str, str]] = schemas.STAR) -> None:
    """Create the schema if needed, then drop and recreate its tables below ``location``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {database} LOCATION '{location}'")
    for table, columns in tables.items():
        recreate_table(spark, f"{database}.{table}", columns, f"{location.rstrip('/')}/{table}")


def _not_null(column: Column, name: str) -> Column:
    return F.when(column.isNull(), F.raise_error(F.lit(f"{name} must not be null"))).otherwise(column)


def declared(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The columns in their declared types. A null in a NOT NULL column, a text longer than its VARCHAR and a
    value that does not fit its type stop the write."""
    def checked(name: str, sql_type: str) -> Column:
        column = F.col(name).cast(schemas.simple_type(sql_type))
        if found := re.match(r"VARCHAR\((\d+)\)", sql_type):
            long = F.raise_error(F.lit(f"{name} is longer than {found[1]}"))
            column = F.when(F.length(column) > int(found[1]), long).otherwise(column)
        return (_not_null(column, name) if sql_type.endswith("NOT NULL") else column).alias(name)

    return df.select(*[checked(c, t) for c, t in columns.items()])


def load_by_position(df: DataFrame, table: str, columns: Mapping[str, str] | None = None) -> None:
    """Replace a table's rows; columns are matched by position and cast to the table's types.

    ``columns`` is the table's declaration: nulls in its NOT NULL columns stop the load while it is
    writing, since Spark does not keep that constraint for Parquet tables.
    """
    target = df.sparkSession.table(table).schema
    if len(target) != len(df.columns):
        raise ValueError(f"{table} has {len(target)} columns, the data {len(df.columns)}")
    required = {c for c, t in (columns or {}).items() if t.endswith("NOT NULL")}
    cast = [
        (_not_null(F.col(c), f.name) if f.name in required else F.col(c)).cast(f.dataType).alias(f.name)
        for c, f in zip(df.columns, target.fields)
    ]
    df.select(*cast).write.insertInto(table, overwrite=True)


def load_columns(df: DataFrame, table: str, names: Sequence[str], columns: Mapping[str, str] | None = None) -> None:
    """Replace a table's rows from named columns, put in the table's order."""
    target = df.sparkSession.table(table).columns
    if sorted(target) != sorted(names):
        raise ValueError(f"{table} needs the columns {target}")
    load_by_position(df.select(*target), table, columns)
