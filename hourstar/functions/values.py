"""Exact decimal and time-zone expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_reading(value: Column) -> Column:
    """Two-step rounding of a reading: to two decimals on read, then to one.

    0.045 becomes 0.05 and then 0.1. Values too wide for the type become null.
    """
    return F.round(value.try_cast("decimal(10,2)"), 1).cast("decimal(10,1)")


def mean_of(total: Column, n: Column, decimals: int, sql_type: str) -> Column:
    """Mean from a decimal sum and a count, rounded half up."""
    return F.round(total / n, decimals).cast(sql_type)


def wall_seconds(wall: Column) -> Column:
    """Seconds since 1970-01-01 00:00 on the same clock; independent of the session zone."""
    return (
        F.unix_date(F.to_date(wall)).cast("long") * 86400
        + F.hour(wall) * 3600
        + F.minute(wall) * 60
        + F.second(wall)
    )


def epoch_seconds(wall: Column, zone: str) -> Column:
    """Unix time of a local wall time (string or timestamp_ntz) in a named zone."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), F.to_timestamp_ntz(wall))
    return wall_seconds(utc)


def split_list(text: Column) -> Column:
    """One row per item of a comma-separated list."""
    return F.explode(F.split(text, ","))
