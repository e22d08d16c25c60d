"""Dimensions and fact of the star schema, from a frame with one row per entity and hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourstar.operators.keys import dense_key, lookup_join

# Leading digits of a date key (yyyyMMdd).
PERIODS = {"year": 4, "month": 6, "day": 8}


def dim_entity(df: DataFrame, entity: str, key: str, attributes: Sequence[str] = (),
               key_type: str = "int", scratch: str | None = None) -> DataFrame:
    """One row per entity name, numbered 1..N in name order.

    The number is positional: a new name renumbers the ones after it. Should attributes differ
    between the rows of a name, the smallest combination is kept, so the fact cannot fan out.
    """
    names = df.select(entity, *attributes).distinct()
    if attributes:
        least = F.min(F.struct(*attributes))
        names = names.groupBy(entity).agg(least.alias("_a")).select(entity, "_a.*")
    return dense_key(names, [entity], key, key_type, scratch)


def dim_date(df: DataFrame, time: str) -> DataFrame:
    """One row per calendar day; the parts are derived after the days have been made distinct."""
    days = df.select(F.to_date(time).alias("date")).distinct()
    return days.select(
        F.date_format("date", "yyyyMMdd").alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.day("date").alias("day"),
        F.date_format("date", "E").alias("day_of_week"),
        F.trunc("date", "year").alias("start_of_year"),
        F.trunc("date", "quarter").alias("start_of_quarter"),
        F.trunc("date", "month").alias("start_of_month"),
    )


def dim_time(df: DataFrame, time: str) -> DataFrame:
    """One row per hour of day that occurs."""
    hours = df.select(F.hour(time).alias("hour")).distinct()
    return hours.select(F.lpad(F.col("hour").cast("string"), 2, "0").alias("time_key"), "hour")


def fact(df: DataFrame, dim: DataFrame, entity: str, time: str, key: str, measures: Sequence[str]) -> DataFrame:
    """Fact rows with date and time keys, and the entity name replaced by its number.

    The keys are their zero-padded text. Whether ``dim``, best a stored table, is broadcast is left to its size.
    """
    return lookup_join(df, dim.select(entity, key), entity, hashed=True).select(
        F.date_format(time, "yyyyMMdd").alias("record_date"),
        F.date_format(time, "HH").alias("record_time"),
        key,
        *measures,
    )


def with_period(df: DataFrame, period: str, date: str = "record_date") -> DataFrame:
    """The rows with the year, month or day of their date key, as text, in ``period``: what a fact's files are split by."""
    return df.withColumn("period", F.substring(date, 1, PERIODS[period]))


def star_join(fact_df: DataFrame, dates: DataFrame, times: DataFrame, entities: DataFrame, key: str, period: str | None = None) -> DataFrame:
    """The fact with all three dimensions. Dates and hours are bounded by the calendar.

    ``period`` is what the fact's files are split by. The join then asks for it, too, so that of a fact joined with some
    of the dates only their periods' files are opened.
    """
    calendar, on = dates.withColumnRenamed("date_key", "record_date"), ["record_date"]
    if period:
        calendar, on = with_period(calendar, period), ["record_date", "period"]
    by_day = lookup_join(fact_df, calendar, on).drop(*on[1:])
    by_hour = lookup_join(by_day, times.withColumnRenamed("time_key", "record_time"), "record_time")
    return lookup_join(by_hour, entities, key, hashed=True)
