"""Surrogate keys and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourstar.session import stored

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in its low 33 bits


def dense_key(df: DataFrame, order: Sequence[str], key: str, key_type: str = "int",
              scratch: str | None = None) -> DataFrame:
    """Number the rows 1..N in the order of ``order``, which must identify a row.

    Rows are range-partitioned and sorted, so no task sees more than its share, and numbered inside
    each partition. The numbering is stored before the partition sizes are taken from it: sizes
    and rows then come from one layout, also when tasks are retried. Only one row per partition is
    broadcast, and the large side is not shuffled again. It is stored below ``scratch``, by default the
    shared folder.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    numbered = stored(ranged, "numbered", scratch).withColumn("_part", F.shiftright("_id", _ROW_BITS))
    sizes = numbered.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per partition: this window is as small as the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return numbered.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + position).cast(key_type).alias(key), *df.columns
    )


def lookup_join(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "inner", hashed: bool = False) -> DataFrame:
    """Join a lookup table. No job runs and nothing is hinted, save for ``hashed``.

    The planner broadcasts a side whose size is known to be small, AQE one that turns out to be;
    beyond that it is a shuffle join, where AQE splits skewed partitions of ``df``. ``hashed`` is for lookups of one row per
    key and known size: if that is too large to broadcast, a task hashes its share of the lookup and passes ``df`` by, where
    it would otherwise sort its share of ``df``.
    """
    if hashed:
        session = df.sparkSession._jsparkSession.sessionState()
        size = int(str(lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if size > session.conf().autoBroadcastJoinThreshold():
            lookup = lookup.hint("shuffle_hash")
    return df.join(lookup, on, how)


def first_row(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One whole row per key: the smallest by ``order``, among equals by all other columns in turn.

    The order is total, so the same row is kept whatever the layout. Copies of a key are combined
    before the shuffle.
    """
    rest = [order, *(c for c in df.columns if c not in keys and c != order)]
    least = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_least"))
    return least.select(*keys, "_least.*").select(*df.columns)


def first_match(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row per key by ``order``, as a lookup that answers each key once."""
    return first_row(df, [key], order)


def enrich(df: DataFrame, lookup: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """Add the lookup's columns from the first match per key; rows without a match get nulls."""
    matches = first_match(lookup.select(*dict.fromkeys([key, order, *columns])), key, order)
    return lookup_join(df, matches.select(key, *columns), key, "left")
