"""Session set-up and the few settings the operators read from it."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ARROW_TYPES = {"INT": pa.int32(), "DOUBLE": pa.float64(), "STRING": pa.string(), "BOOLEAN": pa.bool_()}


def build_session(app: str = "hourstar", time_zone: str = "Asia/Bangkok", **conf: str) -> SparkSession:
    """A session in the readings' time zone. Cluster settings come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", time_zone)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Recording the call site of every column expression slows down building large plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or else a folder in the session's warehouse.

    Both are shared by all executors; a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path below ``folder``, by default the shared one, that no earlier run has used."""
    return f"{(folder or shared_dir(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below ``folder``, by default the shared one, and read it back.

    It is then computed once, outlives executors, is read by column, and its size is known to the
    optimizer.
    """
    path = scratch_path(df.sparkSession, name, folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, rows: Iterable[tuple], columns: Mapping[str, str]) -> DataFrame:
    """A small fixed table. From Arrow it becomes a local relation, which needs no Python worker to read."""
    values = dict(zip(columns, map(list, zip(*rows))))
    table = pa.table({c: pa.array(values[c], _ARROW_TYPES[t]) for c, t in columns.items()})
    ddl = ", ".join(f"`{c}` {t}{'' if None in values[c] else ' NOT NULL'}" for c, t in columns.items())
    return spark.createDataFrame(table, ddl)


def empty_table(spark: SparkSession, columns: Mapping[str, str]) -> DataFrame:
    """A typed table without rows: the start of a union, or the result for empty input."""
    return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in columns.items()])
