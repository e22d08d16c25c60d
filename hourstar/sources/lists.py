"""Reference lists: entities and coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourstar import schemas
from hourstar.functions.values import split_list


def entity_list(spark: SparkSession, path: str, column: str = "ADM1_EN", entity: str = "province_name",
                schema: str | None = None) -> DataFrame:
    """The entity names of a CSV file with a header.

    Without ``schema`` all columns are read as text under their header names, and only the named one
    is parsed.
    """
    reader = spark.read.option("header", True)
    if schema:
        reader = reader.schema(schema)
    return reader.csv(path).withColumnRenamed(column, entity).select(entity)


def entities_from_text(spark: SparkSession, names: str, entity: str = "province_name") -> DataFrame:
    """The entity names of a comma-separated parameter."""
    return spark.range(1).select(split_list(F.lit(names)).alias(entity))


def coordinates(spark: SparkSession, path: str) -> DataFrame:
    """Coordinates per province, from a CSV file with a header."""
    return spark.read.option("header", True).schema(schemas.COORDINATES).csv(path)
