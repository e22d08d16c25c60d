"""Complete series kept up to date batch by batch: only chunks that a batch touches are computed again.

The state is a folder:

* ``readings/batch=../_chunk=..``: each batch's readings on the grid;
* ``sums/batch=..``: per entity the sum and the number of a batch's readings, whether the batch lists it, and the grid's last slot then;
* ``series/_chunk=..``: the complete series.

A batch touches the chunks of its readings, those whose window reaches back to one of them, all chunks of new entities, the chunks by
which the grid has grown, and, of an entity whose rounded mean has changed, the chunks with a filled hour in reach.
Means come from all sums, not from all readings; readings are opened for touched chunks and their predecessors only. Partitions of
``series`` without a touched chunk are not rewritten.

A batch that failed on the way is repeated under its name: its folders are overwritten, and the other batches tell what
it touches, so the result is the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourstar.operators.grid import Grid
from hourstar.operators.series import rolled_chunks, sql_type
from hourstar.session import stored

SUM_TYPE, MEAN_TYPE = "decimal(38,4)", "decimal(14,5)"


def _means(sums: DataFrame, entity: str, value: str, decimals: int, kind: str) -> DataFrame:
    """As the mean over all readings gives them, rounded; of entities that any batch lists."""
    total = sums.groupBy(entity).agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), F.max("_listed").alias("_listed")).where("_listed")
    mean = F.when(F.col("_n") > 0, F.round((F.col("_sum") / F.col("_n")).cast(MEAN_TYPE), decimals).cast(kind))
    return total.select(entity, mean.alias(f"_mean_{value}"))


def _read(spark: SparkSession, path: str, like: DataFrame, extra: str = "") -> DataFrame:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
    return spark.read.schema(fields + extra).parquet(path)


def add_batch(state: str, name: str, readings: DataFrame, entities: DataFrame, *, entity: str, time: str, value: str, order: str,
              grid: Grid, decimals: int = 1, rows: int = 24, rolling: str = "rolling_mean") -> DataFrame:
    """Adds a batch and updates the series; returns the touched ``entity, _chunk`` pairs.

    The series then equals ``complete_series`` of all batches' readings (decimals with a total order ``order``) and entities;
    readings of an entity count as soon as any batch lists it. The grid of every batch has the same start, step and chunk and ends where the last one did or later.
    """
    spark, halo = readings.sparkSession, rows - 1
    kind, slot = sql_type(readings, value), F.col("_slot")
    last, last_chunk = spark.range(1).select(grid.last_slot.cast("int"), grid.last_chunk.cast("int")).first()
    on_grid = readings.where(grid.contains(F.col(time))).withColumn("_slot", grid.slot_of(F.col(time))).withColumn("_chunk", grid.chunk_of(slot))
    batch = on_grid.select(entity, "_slot", F.col(order).alias("_order"), value, "_chunk")
    batch.write.mode("overwrite").partitionBy("_chunk").parquet(f"{state}/readings/batch={name}")
    # With the schema given, the folder of a batch without readings can be read, too.
    own = _read(spark, f"{state}/readings/batch={name}", batch)
    counted = own.groupBy(entity).agg(F.sum(F.col(value).cast(SUM_TYPE)).alias("_sum"), F.count(value).alias("_n"))
    listed = entities.select(entity).distinct().withColumn("_listed", F.lit(True))
    sums = listed.join(counted, entity, "full").select(
        entity, F.coalesce("_listed", F.lit(False)).alias("_listed"), F.coalesce("_sum", F.lit(0)).cast(SUM_TYPE).alias("_sum"), F.coalesce("_n", F.lit(0)).cast("long").alias("_n"), F.lit(last).alias("_last"))
    sums.write.mode("overwrite").parquet(f"{state}/sums/batch={name}")

    every = _read(spark, f"{state}/sums", sums, ", batch STRING")
    others = every.where(F.col("batch") != name)
    before = _means(others, entity, value, decimals, kind).withColumnRenamed(f"_mean_{value}", "_before").withColumn("_known", F.lit(True))
    means = stored(_means(every, entity, value, decimals, kind).join(before, entity, "left"), "means")
    old_last = others.agg(F.max("_last")).first()[0]
    pairs = [own.join(means, entity, "left_semi").select(entity, F.explode(grid.chunks_needing(slot, halo)).alias("_chunk"))]
    first_new = 0 if old_last is None else (old_last + 1) // grid.chunk if last > old_last else last_chunk + 1
    grown = F.when(F.col("_known"), F.lit(first_new)).otherwise(0)
    pairs.append(means.withColumn("_first", grown).where(F.col("_first") <= last_chunk).select(
        entity, F.explode(F.sequence("_first", F.lit(last_chunk))).alias("_chunk")))
    fields = f"`{entity}` {sql_type(batch, entity)}, _hour INT, _own BOOLEAN, `{value}` {kind}, `{rolling}` {kind}, _chunk INT"
    series = spark.read.schema(fields).parquet(f"{state}/series") if old_last is not None else None
    if series is not None:
        changed = means.where(F.col("_known") & ~F.col(f"_mean_{value}").eqNullSafe(F.col("_before"))).select(entity)
        filled = series.where(~F.col("_own")).select(entity, F.explode(grid.chunks_needing(F.col("_hour"), halo)).alias("_chunk"))
        pairs.append(filled.distinct().join(changed, entity, "left_semi"))
    touched = stored(reduce(DataFrame.unionByName, pairs).distinct(), "touched")

    # At most one number per chunk of the grid.
    chunks = sorted(r[0] for r in touched.select("_chunk").distinct().collect())
    if not chunks:
        return touched
    needed = sorted({*chunks, *(c - 1 for c in chunks)})
    history = _read(spark, f"{state}/readings", batch, ", batch STRING").where(F.col("_chunk").isin(needed))
    placed = history.withColumn("_chunk", F.explode(grid.chunks_needing(slot, halo))).join(touched, [entity, "_chunk"], "left_semi")
    kept = (
        placed.groupBy(entity, "_chunk", "_slot").agg(F.min(F.struct("_order", value)).alias("_first"))
        .select(entity, "_chunk", "_slot", F.col(f"_first.{value}").alias(value)).withColumn("_reading", F.lit(True))
    )
    anchors = touched.join(means.select(entity, f"_mean_{value}"), entity).withColumn(
        "_slot", F.greatest(grid.chunk_start(F.col("_chunk")) - halo, F.lit(0))).withColumn("_reading", F.lit(False))
    tasks = grid.partitions(spark, -(-touched.count() // (last_chunk + 1)))
    new = rolled_chunks(anchors, kept, entity=entity, fill={value: kind}, value=value, grid=grid, halo=halo, rolling=rolling, tasks=tasks)
    new = new.select(entity, "_hour", "_own", value, rolling, "_chunk")
    if series is not None:
        rest = series.where(F.col("_chunk").isin(chunks)).join(touched, [entity, "_chunk"], "left_anti")
        new = new.unionByName(rest)
    # Stored first, as the partitions that are rewritten are read here.
    ready = stored(new, "chunks")
    ready.repartitionByRange("_chunk", entity).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_chunk").parquet(f"{state}/series")
    return touched


def current_series(spark: SparkSession, state: str, *, entity: str, entity_type: str, time: str, value: str, value_type: str, grid: Grid,
                   time_type: str = "timestamp", rolling: str = "rolling_mean") -> DataFrame:
    """``entity, time, value, rolling mean`` of every hour."""
    fields = f"`{entity}` {entity_type}, _hour INT, `{value}` {value_type}, `{rolling}` {value_type}"
    return spark.read.schema(fields).parquet(f"{state}/series").select(
        entity, grid.time_of(F.col("_hour"), time_type).alias(time), value, rolling)
