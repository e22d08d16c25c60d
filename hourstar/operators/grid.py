"""A regular time grid, and the arithmetic that places times on it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourstar.session import shuffle_partitions


# Grid rows a task should generate at most, a few hundred megabytes.
ROWS_PER_TASK = 4_000_000


def int_div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


@dataclass(frozen=True)
class Grid:
    """Slots from ``start`` to ``end``, both inclusive, one per step.

    The bounds are read in the session time zone. An ``end`` between two steps closes the grid at
    the step before it. Slots are numbered from 0; the bounds are literals, so Catalyst folds all of
    this to constants.

    Work that needs a whole series in order is cut into chunks of ``chunk`` slots, so that the size
    of a window group depends neither on the length of the range nor on the number of readings.
    """

    start: str
    end: str
    step_seconds: int = 3600
    chunk: int = 720

    def __post_init__(self) -> None:
        if datetime.fromisoformat(self.end) < datetime.fromisoformat(self.start):
            raise ValueError(f"the grid ends at {self.end}, before its start {self.start}")

    @property
    def _start_us(self) -> Column:
        return F.unix_micros(F.lit(self.start).cast("timestamp"))

    @property
    def _step_us(self) -> int:
        return self.step_seconds * 1_000_000

    @property
    def last_slot(self) -> Column:
        end_us = F.unix_micros(F.lit(self.end).cast("timestamp"))
        return int_div(end_us - self._start_us, self._step_us)

    @property
    def last_chunk(self) -> Column:
        return int_div(self.last_slot, self.chunk)

    def partitions(self, spark: SparkSession, n_entities: int | None) -> int:
        """How many tasks should generate the grid of ``n_entities``.

        Rows generated after a shuffle are not in AQE's size estimate, which would merge the small
        input into one task. At least the session's shuffle partitions, and more for a grid that
        needs them.
        """
        span = datetime.fromisoformat(self.end) - datetime.fromisoformat(self.start)
        rows = (n_entities or 0) * (span.total_seconds() // self.step_seconds + 1)
        return max(shuffle_partitions(spark), ceil(rows / ROWS_PER_TASK))

    def contains(self, time: Column) -> Column:
        """True for times that are a slot of the grid. The range part reaches the scan."""
        offset = F.unix_micros(time.cast("timestamp")) - self._start_us
        in_range = time.between(F.lit(self.start).cast("timestamp"), F.lit(self.end).cast("timestamp"))
        return in_range & (offset % self._step_us == 0)

    def slot_of(self, time: Column) -> Column:
        return int_div(F.unix_micros(time.cast("timestamp")) - self._start_us, self._step_us).cast("int")

    def time_of(self, slot: Column, sql_type: str = "timestamp") -> Column:
        return F.timestamp_micros(self._start_us + slot.cast("long") * self._step_us).cast(sql_type)

    def chunk_of(self, slot: Column) -> Column:
        return int_div(slot, self.chunk).cast("int")

    def chunks_needing(self, slot: Column, halo: int) -> Column:
        """The slot's own chunk and, for its last ``halo`` slots, the chunk after it."""
        own = self.chunk_of(slot)
        feeds_next = (slot % self.chunk >= self.chunk - halo) & (own < self.last_chunk)
        return F.when(feeds_next, F.array(own, own + 1)).otherwise(F.array(own))

    def chunk_start(self, chunk: Column) -> Column:
        return (chunk * self.chunk).cast("int")

    def chunk_end(self, chunk: Column) -> Column:
        return F.least(chunk * self.chunk + self.chunk - 1, self.last_slot).cast("int")


def hourly_spine(entities: DataFrame, entity: str, grid: Grid, time: str = "datetime",
                 time_type: str = "timestamp", n_entities: int | None = None) -> DataFrame:
    """Every entity at every slot of the grid.

    The list of entities is small next to the result, so it is first cut into (entity, chunk) pieces
    and spread over ``grid.partitions`` tasks. Where the number of entities is not given, it is counted.
    """
    if n_entities is None:
        n_entities = entities.select(entity).distinct().count()
    pieces = (
        entities.select(entity)
        .distinct()
        .select(entity, F.explode(F.sequence(F.lit(0).cast("long"), grid.last_chunk)).alias("_chunk"))
        .repartition(grid.partitions(entities.sparkSession, n_entities), entity, "_chunk")
    )
    slots = F.sequence(grid.chunk_start(F.col("_chunk")), grid.chunk_end(F.col("_chunk")))
    return pieces.select(entity, F.explode(slots).alias("_slot")).select(
        entity, grid.time_of(F.col("_slot"), time_type).alias(time)
    )
