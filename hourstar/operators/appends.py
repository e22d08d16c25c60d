"""Tables that grow by loads, with a surrogate key that goes on from load to load.

A table is a folder:

* ``rows/<n>``: the rows of load ``n``, with their keys;
* ``loads/<n>``: one line with the load's name, its first and last key; written last, so a load without it does not exist.

The last key of the last load is the table's high-water mark: the next load numbers its rows from there, without looking at
the rows before. Numbers are gapless and unique over all loads, and never given again. A load that failed on
the way is repeated under its name, and its rows are overwritten; one that is there already is not loaded again. Loads
are made one at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourstar.operators.keys import dense_key

_LOADS = "number INT, name STRING, first LONG, last LONG, fields STRING"


class OutOfOrder(RuntimeError):
    """Another load took the number."""


def loads(spark: SparkSession, folder: str) -> list:
    """The table's loads in order, one small row each."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/loads")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    found = spark.read.schema(_LOADS).json(f"{folder}/loads/*").collect()
    found.sort(key=lambda load: load.number)
    if [load.number for load in found] != list(range(len(found))):
        raise OutOfOrder(f"loads of {folder}: {[load.number for load in found]}")
    return found


def append_numbered(folder: str, name: str, df: DataFrame, order: Sequence[str], key: str, key_type: str = "int") -> int:
    """Append the rows of load ``name``, numbered in the order of ``order``, which must identify a row; returns the last number.

    Rows are numbered by ``dense_key``: inside range partitions, with an offset for each; the table's high-water
    mark is one more offset. A number that ``key_type`` cannot hold stops the load. Columns must stay the same.
    """
    spark = df.sparkSession
    before = loads(spark, folder)
    for load in before:
        if load.name == name:
            return load.last
    mark = before[-1].last if before else 0
    path = f"{folder}/rows/{len(before)}"
    numbered = dense_key(df, order, key, "bigint", scratch=f"{folder}/scratch")
    numbered = numbered.withColumn(key, (F.col(key) + mark).try_cast(key_type))
    checked = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"{key} does not fit {key_type}"))).otherwise(F.col(key))
    rows = numbered.withColumn(key, checked)
    fields = json.loads(rows.schema.json())
    for field in fields["fields"]:
        field["nullable"] = True
    if before and json.loads(before[-1].fields) != fields:
        raise ValueError(f"load {name!r} has other columns than the table")
    rows.write.mode("overwrite").parquet(path)
    last = mark + spark.read.schema(rows.schema).parquet(path).count()  # from the files' footers
    line = spark.createDataFrame([(len(before), name, mark + 1, last, json.dumps(fields))], _LOADS)
    line.coalesce(1).write.mode("error").json(f"{folder}/loads/{len(before)}")
    return last


def appended(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all complete loads."""
    found = loads(spark, folder)
    if not found:
        raise ValueError(f"nothing has been loaded into {folder}")
    schema = T.StructType.fromJson(json.loads(found[-1].fields))
    return spark.read.schema(schema).parquet(*[f"{folder}/rows/{load.number}" for load in found])
