"""Operators on per-entity time series. All entities are handled in one plan."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hourstar.functions.values import round_reading
from hourstar.operators.grid import Grid, hourly_spine, int_div
from hourstar.operators.keys import first_row


def sql_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def drop_negative(df: DataFrame, value: str) -> DataFrame:
    """Keep values of zero and more. Negatives and nulls go; their hours become gaps to fill."""
    return df.filter(F.col(value) >= 0)


def clean_readings(df: DataFrame, value: str) -> DataFrame:
    """Non-negative readings, judged at two decimals and then rounded to one."""
    two = df.withColumn(value, F.col(value).try_cast("decimal(10,2)"))
    return drop_negative(two, value).withColumn(value, round_reading(F.col(value)))


def dedup(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key: the one with the smallest ``order``, a column without nulls.

    Rows equal in ``order`` are told apart by their other columns. An aggregate rather than a row
    number: copies of a key are combined before the shuffle, so a key that holds a large part of the
    rows arrives as one row per map task.
    """
    return first_row(df, keys, order)


def _mean(df: DataFrame, column: str, decimals: int) -> Column:
    return F.round(F.avg(column), decimals).cast(sql_type(df, column))


def entity_mean(df: DataFrame, entity: str, means: Mapping[str, int], suffix: str = "_mean") -> DataFrame:
    """Per-entity mean of each column, rounded to the given decimals; the column type is kept."""
    return df.groupBy(entity).agg(*[_mean(df, c, d).alias(c + suffix) for c, d in means.items()])


def entity_mode(df: DataFrame, entity: str, value: str, out: str | None = None) -> DataFrame:
    """Most frequent value per entity; among equals the smallest value."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(entity, value).agg(F.count("*").alias("_n"))
    first = F.min_by(value, F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(entity).agg(first.alias(out or value))


def align(entities: DataFrame, readings: DataFrame, entity: str, time: str, grid: Grid,
          n_entities: int | None = None, means: DataFrame | None = None, columns: Sequence[str] = (),
          suffix: str = "_mean") -> DataFrame:
    """The hourly spine left-joined with the readings on (entity, time).

    Readings off the grid, outside the range or of an unlisted entity vanish; hours without a
    reading appear with nulls; several readings of one hour all stay. With ``means`` (one row per
    entity) nulls of ``columns`` are filled at once, as ``impute`` would.

    Everything is keyed by (entity, chunk), so a hot entity is many groups. Listed chunks carry the
    means to the readings. For the empty hours only the distinct (entity, slot) keys move, combined on
    the map side: an hour with very many readings is one of them. The hours between two keys are
    generated after that exchange, and nothing generated is shuffled.
    """
    if n_entities is None:
        n_entities = entities.select(entity).distinct().count()
    slot, chunk = F.col("_slot"), F.col("_chunk")
    carried = [c + suffix for c in columns] if means is not None else []
    listed = entities.select(entity).distinct()
    if carried:
        listed = listed.join(means.select(entity, *carried), entity, "left")
    chunks = listed.withColumn("_chunk", F.explode(F.sequence(F.lit(0), grid.last_chunk.cast("int"))))
    on_grid = readings.filter(grid.contains(F.col(time))).withColumn("_slot", grid.slot_of(F.col(time)))
    placed = on_grid.withColumn("_chunk", grid.chunk_of(slot))

    def filled(values: Mapping[str, Column]) -> list[Column]:
        return [values.get(c, F.col(c)).cast(sql_type(readings, c)).alias(c) for c in readings.columns]

    kept = placed.join(chunks, [entity, "_chunk"]).select(
        *filled({c: F.coalesce(F.col(c), F.col(c + suffix)) for c in columns} if carried else {}))

    keys = placed.select(entity, "_chunk", "_slot").distinct().withColumn("_reading", F.lit(True))
    anchors = chunks.withColumn("_slot", grid.chunk_start(chunk) - 1).withColumn("_reading", F.lit(False))
    pieces = anchors.unionByName(keys, allowMissingColumns=True).repartition(
        grid.partitions(readings.sparkSession, n_entities), entity, "_chunk"
    )
    in_order = Window.partitionBy(entity, "_chunk").orderBy("_slot")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gaps = pieces.withColumns({
        "_next": F.coalesce(F.lead("_slot").over(in_order), grid.chunk_end(chunk) + 1),
        "_listed": ~F.first("_reading").over(so_far),
        **{c: F.first(c).over(so_far) for c in carried},
    }).filter(F.col("_listed") & (F.col("_next") > slot + 1))
    hours = gaps.withColumn("_hour", F.explode(F.sequence(slot + 1, F.col("_next") - 1)))
    given = {entity: F.col(entity), time: grid.time_of(F.col("_hour"), sql_type(readings, time))}
    given |= {c: F.col(c + suffix) for c in columns} if carried else {}
    empty = hours.select(*[given.get(c, F.lit(None)).cast(sql_type(readings, c)).alias(c) for c in readings.columns])
    return kept.unionByName(empty)


def impute(df: DataFrame, means: DataFrame, entity: str, columns: Sequence[str], suffix: str = "_mean") -> DataFrame:
    """Fill nulls with the entity's own mean. Entities without any mean keep their nulls."""
    filled = {c: F.coalesce(F.col(c), F.col(c + suffix)).cast(sql_type(df, c)) for c in columns}
    return df.join(means, entity, "left").withColumns(filled).select(*df.columns)


def _rolling(value: str, kind: str, order: WindowSpec, rows: int) -> Column:
    """The mean of the current and the ``rows - 1`` preceding rows, in the type of the values.

    A frame that moves at both ends is added up anew for every row, in big decimals. Of decimals that fit, running sums
    up to this row and up to the one before the frame are taken as integers; their difference is exact. It is divided
    as ``avg`` does: rounded half up to four more places, then to the type.
    """
    fits = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    if not fits or int(fits[1]) > 12 or rows > 100:
        return F.avg(value).over(order.rowsBetween(1 - rows, Window.currentRow)).cast(kind)
    scale, own = int(fits[2]), F.col(value)
    unit = F.coalesce((own * F.lit(10**scale)).cast("long"), F.lit(0))

    def framed(column: Column) -> Column:
        till = F.sum(column).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return till - F.coalesce(F.sum(column).over(order.rowsBetween(Window.unboundedPreceding, -rows)), F.lit(0))

    total, n = framed(unit), framed(own.isNotNull().cast("long"))
    fine = int_div(F.abs(total) * 20_000 + n, n * 2)
    units = F.sign(total).cast("long") * int_div(fine + 5000, 10_000)
    return F.when(n > 0, (units.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(kind))


def rolling_mean(df: DataFrame, entity: str, time: str, value: str, grid: Grid, rows: int = 24,
                 out: str = "rolling_mean", n_entities: int | None = None) -> DataFrame:
    """Mean over the current and the ``rows - 1`` preceding rows of a complete series.

    ``df`` has one row per entity and slot. Groups are (entity, chunk): each chunk also receives
    the last ``rows - 1`` slots before it, so a long series is shared by many tasks and no group
    exceeds ``chunk + rows - 1`` rows.
    """
    halo = rows - 1
    if halo > grid.chunk:
        raise ValueError("a chunk must be at least as long as the window")
    slot = F.col("_slot")
    order = Window.partitionBy(entity, "_chunk").orderBy("_slot")
    return (
        df.withColumn("_slot", grid.slot_of(F.col(time)))
        .withColumn("_chunk", F.explode(grid.chunks_needing(slot, halo)))
        .repartition(grid.partitions(df.sparkSession, n_entities), entity, "_chunk")
        .withColumn(out, _rolling(value, sql_type(df, value), order, rows))
        .filter(grid.chunk_of(slot) == F.col("_chunk"))
        .drop("_slot", "_chunk")
    )


def complete_series(readings: DataFrame, entities: DataFrame, *, entity: str, time: str, value: str, order: str,
                    grid: Grid, attributes: Mapping[str, int] | None = None, decimals: int = 1, rows: int = 24,
                    rolling: str = "rolling_mean", n_entities: int | None = None) -> DataFrame:
    """Align, de-duplicate, impute and roll every series at once.

    The result equals ``dedup`` + ``align`` + ``impute`` + ``rolling_mean``, but the spine is never
    shuffled. Each (entity, chunk) group travels as its readings plus one anchor row that marks
    where the chunk begins and carries the entity's means; the empty hours are generated after the
    shuffle, between a row and the next one. Two shuffles of readings remain: one by (entity, slot)
    that combines duplicates on the map side first, so that what follows is at most one row per
    slot, and one by (entity, chunk) that serves both windows.

    ``attributes`` are further columns filled with their entity mean, as column -> decimals.
    ``readings`` is scanned twice (means, values): pass a stored table, not a parse of raw files.
    ``n_entities`` sizes the partitions of the grid; where it is not given, the entities are counted.
    """
    if n_entities is None:
        n_entities = entities.select(entity).distinct().count()
    halo = rows - 1
    if halo > grid.chunk:
        raise ValueError("a chunk must be at least as long as the window")
    fill = {value: decimals, **(attributes or {})}
    types = {c: sql_type(readings, c) for c in fill}
    time_type = sql_type(readings, time)
    slot, chunk = F.col("_slot"), F.col("_chunk")

    on_grid = readings.filter(grid.contains(F.col(time)))

    # Means include every reading on the grid, duplicates too.
    means = on_grid.groupBy(entity).agg(*[_mean(readings, c, d).alias(f"_mean_{c}") for c, d in fill.items()])
    chunk_ids = F.sequence(F.lit(0), grid.last_chunk.cast("int"))
    anchors = (
        entities.select(entity)
        .distinct()
        .join(means, entity, "left")
        .withColumn("_chunk", F.explode(chunk_ids))
        .withColumn("_slot", F.greatest(grid.chunk_start(chunk) - halo, F.lit(0)))
        .withColumn("_reading", F.lit(False))
    )
    placed = on_grid.select(entity, grid.slot_of(F.col(time)).alias("_slot"), *{order: None, **fill})
    kept = (
        placed.groupBy(entity, "_slot")
        .agg(F.min(F.struct(F.col(order).alias("_order"), *fill)).alias("_first"))
        .select(entity, "_slot", *[F.col(f"_first.{c}").alias(c) for c in fill])
        .withColumn("_chunk", F.explode(grid.chunks_needing(slot, halo)))
        .withColumn("_reading", F.lit(True))
    )

    tasks = grid.partitions(readings.sparkSession, n_entities)
    hours = rolled_chunks(anchors, kept, entity=entity, fill=types, value=value, grid=grid, halo=halo, rolling=rolling, tasks=tasks)
    return hours.select(entity, grid.time_of(F.col("_hour"), time_type).alias(time), *fill, rolling)


def rolled_chunks(anchors: DataFrame, kept: DataFrame, *, entity: str, fill: Mapping[str, str], value: str, grid: Grid, halo: int,
                  rolling: str, tasks: int) -> DataFrame:
    """``entity, _chunk, _hour, _own``, the columns of ``fill`` (name -> type) and the rolling mean, of every hour of the chunks.

    ``anchors``: a row per (entity, chunk) with ``_slot``, the first hour its window needs, ``_reading`` false and ``_mean_..``.
    ``kept``: the readings, one per hour, in every chunk that needs them. ``_own`` tells them from filled hours.
    """
    slot, chunk = F.col("_slot"), F.col("_chunk")
    # A fixed partition count: the hours generated below are not in AQE's size estimate.
    pieces = anchors.unionByName(kept, allowMissingColumns=True).repartition(tasks, entity, "_chunk")
    in_order = Window.partitionBy(entity, "_chunk").orderBy("_slot", "_reading")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gaps = pieces.withColumns({
        "_next": F.coalesce(F.lead("_slot").over(in_order), grid.chunk_end(chunk) + 1),
        "_listed": ~F.first("_reading").over(so_far),
        **{f"_mean_{c}": F.first(f"_mean_{c}").over(so_far) for c in fill},
    })
    hours = gaps.filter(F.col("_listed") & (F.col("_next") > slot)).withColumn(
        "_hour", F.explode(F.sequence(slot, F.col("_next") - 1))
    )
    own = F.col("_reading") & (F.col("_hour") == slot)
    filled = hours.select(
        entity, "_chunk", "_hour", own.alias("_own"),
        *[F.coalesce(F.when(own, F.col(c)), F.col(f"_mean_{c}")).cast(t).alias(c) for c, t in fill.items()],
    )
    order = Window.partitionBy(entity, "_chunk").orderBy("_hour")
    rolled = filled.withColumn("_rolled", _rolling(value, fill[value], order, halo + 1))
    # Behind a generator, so that conditions on the mean do not repeat its arithmetic.
    return rolled.withColumn(rolling, F.explode(F.array("_rolled"))).drop("_rolled").filter(F.col("_hour") >= grid.chunk_start(chunk))
