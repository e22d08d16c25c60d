"""Air-quality index from a PM2.5 concentration, by piecewise-linear bands.

The bands are a fixed seven-row table known when the plan is built, so the lookup is a CASE
expression: no join, no fan-out, and it stays inside whole-stage codegen. Concentrations must be
rounded to one decimal first, because the bands leave gaps of 0.1; a value inside a gap, a
negative one or null has no band and yields null.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourstar import schemas
from hourstar.session import literal_table


class Band(NamedTuple):
    c_low: float
    c_high: float
    i_low: int
    i_high: int
    label: str


# The published breakpoints of the 24-hour PM2.5 index.
PM25_BANDS = (
    Band(0.0, 12.0, 0, 50, "Good"),
    Band(12.1, 35.4, 51, 100, "Moderate"),
    Band(35.5, 55.4, 101, 150, "Unhealthy for Sensitive Groups"),
    Band(55.5, 150.4, 151, 200, "Unhealthy"),
    Band(150.5, 250.4, 201, 300, "Very Unhealthy"),
    Band(250.5, 350.4, 301, 400, "Hazardous"),
    Band(350.5, 500.4, 401, 500, "Hazardous"),
)


def _by_band(value: Column, low: str, high: str, result: Callable[[Band], Column], overflow: Column | None,
             bands: Sequence[Band]) -> Column:
    """CASE over the bands; ``overflow`` answers for values above the last one."""
    def bound(x: float | int) -> Column:
        # A decimal literal compares with a decimal column without a cast to double.
        return F.lit(Decimal(str(x)))

    chain = F
    for band in bands:
        inside = value.between(bound(getattr(band, low)), bound(getattr(band, high)))
        chain = chain.when(inside, result(band))
    if overflow is not None:
        chain = chain.when(value > bound(getattr(bands[-1], high)), overflow)
    return chain


def aqi(concentration: Column, bands: Sequence[Band] = PM25_BANDS) -> Column:
    """Index rounded half away from zero; the top of the scale for anything above the last band."""
    def interpolate(band: Band) -> Column:
        slope = (band.i_high - band.i_low) / (band.c_high - band.c_low)
        raw = F.lit(slope) * (concentration.cast("double") - F.lit(band.c_low)) + F.lit(band.i_low)
        return F.round(raw, 0).cast("int")

    return _by_band(concentration, "c_low", "c_high", interpolate, F.lit(bands[-1].i_high), bands)


def severity(concentration: Column, bands: Sequence[Band] = PM25_BANDS) -> Column:
    """Severity label of a concentration."""
    return _by_band(concentration, "c_low", "c_high", lambda b: F.lit(b.label), F.lit(bands[-1].label), bands)


def severity_of_index(index: Column, bands: Sequence[Band] = PM25_BANDS) -> Column:
    """Severity label of an index value, for tables that keep only the index."""
    return _by_band(index, "i_low", "i_high", lambda b: F.lit(b.label), F.lit(bands[-1].label), bands)


def band_number(concentration: Column, bands: Sequence[Band] = PM25_BANDS) -> Column:
    """Position of the band that holds a concentration, 0 for the first."""
    position = {band: i for i, band in enumerate(bands)}
    return _by_band(concentration, "c_low", "c_high", lambda b: F.lit(position[b]), F.lit(len(bands) - 1), bands)


def breakpoints(spark: SparkSession, bands: Sequence[Band] = PM25_BANDS) -> DataFrame:
    """The bands as a table."""
    return literal_table(spark, [band[:4] for band in bands], schemas.BREAKPOINTS)


def join_bands(df: DataFrame, concentration: str, bands: Sequence[Band] = PM25_BANDS) -> DataFrame:
    """Each row with the breakpoint row of its band; rows without a band are dropped.

    The range condition becomes an equality on the band number, so this is a hash join against
    seven broadcast rows, and a value above the last band still matches exactly one of them.
    """
    rows = [(i, *band) for i, band in enumerate(bands)]
    table = literal_table(df.sparkSession, rows, {"band": "INT", **schemas.BREAKPOINTS, "label": "STRING"})
    return (
        df.withColumn("band", band_number(F.col(concentration), bands))
        .join(F.broadcast(table), "band")
        .drop("band")
    )


def has_band(concentration: Column, bands: Sequence[Band] = PM25_BANDS) -> Column:
    """True where a band holds the concentration, or it lies above the last one."""
    inside = concentration > F.lit(Decimal(str(bands[-1].c_high)))
    for band in bands:
        inside = concentration.between(F.lit(Decimal(str(band.c_low))), F.lit(Decimal(str(band.c_high)))) | inside
    return inside


def with_aqi(df: DataFrame, concentration: str, out: str = "aqi", bands: Sequence[Band] = PM25_BANDS) -> DataFrame:
    """Add the index; rows whose concentration has no band are dropped."""
    value = F.col(concentration)
    return df.filter(has_band(value, bands)).withColumn(out, aqi(value, bands))
