"""The index over every tenth, and its anchors."""

import math
from decimal import Decimal

from pyspark.sql import functions as F

from hourstar.functions import aqi

ANCHORS = {
    "0": 0, "6": 25, "12": 50, "12.1": 51, "20": 68, "35.4": 100, "35.5": 101, "55.4": 150, "55.5": 151, "100": 174,
    "150.4": 200, "150.5": 201, "250.4": 300, "250.5": 301, "350.4": 400, "350.5": 401, "500.4": 500, "500.5": 500,
    "9999.9": 500,
}


def frame(spark, values):
    return spark.createDataFrame([(Decimal(v),) for v in values], "c DECIMAL(10,1)")


def test_anchors(spark):
    rows = aqi.with_aqi(frame(spark, ANCHORS), "c").collect()
    assert {r.c: r.aqi for r in rows} == {Decimal(k): v for k, v in ANCHORS.items()}


def test_every_tenth(spark):
    rows = spark.range(0, 5105).select((F.col("id") / 10).cast("decimal(10,1)").alias("c"))
    found = {float(r.c): r.aqi for r in aqi.with_aqi(rows, "c").collect()}
    assert len(found) == 5105
    for c, index in found.items():
        band = next((b for b in aqi.PM25_BANDS if b.c_low <= c <= b.c_high), None)
        exact = 500.0 if band is None else (
            (band.i_high - band.i_low) / (band.c_high - band.c_low) * (c - band.c_low) + band.i_low)
        assert index == math.floor(exact + 0.5)


def test_band_join_gives_one_row_per_value_and_agrees_with_the_expression(spark):
    df = frame(spark, ANCHORS)
    joined = aqi.join_bands(df, "c")
    assert joined.count() == len(ANCHORS)
    line = (F.col("i_high") - F.col("i_low")) / (F.col("c_high") - F.col("c_low")) * (F.col("c") - F.col("c_low"))
    value = F.when(F.col("c") <= 500.4, F.round(line + F.col("i_low"), 0).cast("int")).otherwise(500)
    assert {r.c: r.v for r in joined.select("c", value.alias("v")).collect()} == {
        Decimal(k): v for k, v in ANCHORS.items()}


def test_values_without_a_band_are_dropped(spark):
    df = spark.createDataFrame([(None,), (Decimal("-0.1"),), (Decimal("12.05"),), (Decimal("1.00"),)],
                               "c DECIMAL(10,2)")
    assert [str(r.c) for r in aqi.with_aqi(df, "c").collect()] == ["1.00"]
    assert [str(r.c) for r in aqi.join_bands(df, "c").collect()] == ["1.00"]


def test_severity(spark):
    wanted = {"12": "Good", "12.1": "Moderate", "35.5": "Unhealthy for Sensitive Groups", "55.5": "Unhealthy",
              "150.5": "Very Unhealthy", "250.5": "Hazardous", "350.5": "Hazardous", "600": "Hazardous"}
    df = aqi.with_aqi(frame(spark, wanted), "c")
    rows = df.select("c", aqi.severity(F.col("c")).alias("s"), aqi.severity_of_index(F.col("aqi")).alias("i")).collect()
    assert {r.c: r.s for r in rows} == {Decimal(k): v for k, v in wanted.items()}
    assert all(r.s == r.i for r in rows)


def test_breakpoint_table(spark):
    table = aqi.breakpoints(spark)
    assert [tuple(r) for r in table.orderBy("i_low").collect()] == [b[:4] for b in aqi.PM25_BANDS]
    assert [t for _, t in table.dtypes] == ["double", "double", "int", "int"]
    assert not any(f.nullable for f in table.schema.fields)
