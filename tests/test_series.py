"""Grid and series operators on small hand-made and random series."""

import random
import re
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from hourstar.operators import series
from hourstar.operators.grid import Grid, hourly_spine

D = Decimal


def hours(spark, grid, names="a"):
    spine = hourly_spine(spark.createDataFrame([(n,) for n in names], "e STRING"), "e", grid)
    return [str(r.datetime)[11:16] for r in spine.orderBy("e", "datetime").collect()]


def test_spine_includes_an_end_on_the_step_and_stops_before_one_off_it(spark):
    assert hours(spark, Grid("2024-01-01 00:00:00", "2024-01-01 03:00:00")) == ["00:00", "01:00", "02:00", "03:00"]
    assert hours(spark, Grid("2024-01-01 00:00:00", "2024-01-01 03:30:00")) == ["00:00", "01:00", "02:00", "03:00"]
    assert hours(spark, Grid("2024-01-01 00:00:00", "2024-01-01 00:00:00")) == ["00:00"]
    assert hours(spark, Grid("2024-01-01 00:30:00", "2024-01-01 02:00:00")) == ["00:30", "01:30"]


@pytest.mark.parametrize("chunk", [1, 2, 5, 6, 7, 100])
def test_spine_does_not_depend_on_chunks(spark, chunk):
    grid = Grid("2024-01-01 00:00:00", "2024-01-01 05:00:00", chunk=chunk)
    assert hours(spark, grid, "ab") == [f"{h:02d}:00" for h in range(6)] * 2


def test_large_grids_get_more_partitions(spark):
    grid = Grid("2021-01-01 00:00:00", "2024-12-31 23:00:00")
    assert grid.partitions(spark, None) == grid.partitions(spark, 77) == 4
    assert grid.partitions(spark, 1_000_000) == 8766


def random_readings(seed, n_hours):
    """Gaps, copies, off-grid and out-of-range readings; one entity holds most of the rows."""
    rng = random.Random(seed)
    rows = []
    for entity, n in (("hot", 400), ("thin", 5), ("mid", 60), ("unlisted", 30)):
        for _ in range(n):
            offset = 3600 * rng.randrange(-5, n_hours + 5) + (60 if rng.random() < 0.05 else 0)
            rows.append((entity, offset, len(rows), D(rng.randrange(0, 3000)) / 10))
    return rows


def half_up(x, places="0.1"):
    return x.quantize(D(places), ROUND_HALF_UP)


def brute_force(rows, entities, n_hours, window):
    """Plain loops with the same meaning."""
    out = {}
    for entity in entities:
        mine = [r for r in rows if r[0] == entity and r[1] % 3600 == 0 and 0 <= r[1] < 3600 * n_hours]
        mean = half_up(sum(r[3] for r in mine) / len(mine)) if mine else None
        first = {}
        for _, offset, order, value in sorted(mine, key=lambda r: r[2]):
            first.setdefault(offset // 3600, value)
        values = [first.get(h, mean) for h in range(n_hours)]
        for h in range(n_hours):
            part = values[max(0, h - window + 1):h + 1]
            out[entity, h] = (values[h], half_up(sum(part) / len(part)) if mine else None)
    return out


def as_frame(spark, rows):
    return spark.createDataFrame(rows, "e STRING, off BIGINT, o BIGINT, v DECIMAL(10,1)").select(
        "e", F.timestamp_seconds(F.lit(1704067200) + F.col("off")).alias("t"), "o", "v"
    )


@pytest.mark.parametrize("chunk,window", [(24, 24), (23, 24), (30, 5), (50, 24), (51, 24), (720, 24), (3, 1)])
def test_fused_and_stepwise_series_equal_brute_force(spark, chunk, window):
    n_hours = 100
    rows = random_readings(chunk, n_hours)
    entities = ["hot", "thin", "mid", "silent"]
    expected = brute_force(rows, entities, n_hours, window)
    grid = Grid("2024-01-01 00:00:00", "2024-01-05 03:00:00", chunk=chunk)
    df = as_frame(spark, rows)
    listed = spark.createDataFrame([(e,) for e in entities], "e STRING")

    fused = series.complete_series(df, listed, entity="e", time="t", value="v", order="o", grid=grid, rows=window,
                                   rolling="r")
    inside = df.filter(grid.contains(F.col("t")))
    filled = series.impute(
        series.align(listed, series.dedup(df, ["e", "t"], "o"), "e", "t", grid),
        series.entity_mean(inside, "e", {"v": 1}), "e", ["v"])
    stepwise = series.rolling_mean(filled, "e", "t", "v", grid, window, "r")
    for result in (fused, stepwise):
        hour = ((F.unix_timestamp("t") - 1704067200) / 3600).cast("int")
        found = result.select("e", hour.alias("h"), "v", "r").collect()
        assert len(found) == len(expected)
        assert {(r.e, r.h): (r.v, r.r) for r in found} == expected


def test_window_longer_than_a_chunk_is_refused(spark):
    df = as_frame(spark, random_readings(0, 10))
    grid = Grid("2024-01-01 00:00:00", "2024-01-01 09:00:00", chunk=10)
    with pytest.raises(ValueError):
        series.rolling_mean(df, "e", "t", "v", grid, rows=24)


def test_align_keeps_every_copy_and_lists_every_empty_hour(spark):
    rows = random_readings(1, 50)
    grid = Grid("2024-01-01 00:00:00", "2024-01-03 01:00:00")
    listed = spark.createDataFrame([("hot",), ("silent",)], "e STRING")
    found = series.align(listed, as_frame(spark, rows), "e", "t", grid)
    spine = hourly_spine(listed, "e", grid, "t")
    plain = spine.join(as_frame(spark, rows), ["e", "t"], "left").select(found.columns)
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()


def test_negative_and_null_readings_are_dropped_at_two_decimals(spark):
    df = spark.createDataFrame([(1, "0.045"), (2, "-0.04"), (3, None), (4, "-9999"), (5, "0"), (6, "123456789012.5"),
                                (7, "-0.004"), (8, "0.25")], "id INT, v STRING")
    df = df.withColumn("v", F.col("v").cast("decimal(20,4)"))
    rows = {r.id: r.v for r in series.clean_readings(df, "v").collect()}
    assert rows == {1: D("0.1"), 5: D("0.0"), 7: D("0.0"), 8: D("0.3")}


def test_mode_breaks_ties_by_value_and_ignores_nulls(spark):
    rows = [("a", "y"), ("a", "x"), ("a", None), ("a", None), ("a", None), ("b", "z"), ("b", "z"), ("b", "a")]
    df = spark.createDataFrame(rows, "e STRING, v STRING")
    assert {r.e: r.v for r in series.entity_mode(df, "e", "v").collect()} == {"a": "x", "b": "z"}


def test_means_keep_the_column_type(spark):
    df = spark.createDataFrame([("a", D("1.0"), D("7.54781")), ("a", D("1.1"), None), ("b", None, D("1"))],
                               "e STRING, v DECIMAL(10,1), lat DECIMAL(10,4)")
    out = series.entity_mean(df, "e", {"v": 1, "lat": 4})
    assert dict(out.dtypes)["v_mean"] == "decimal(10,1)"
    rows = {r.e: (r.v_mean, r.lat_mean) for r in out.collect()}
    assert rows == {"a": (D("1.1"), D("7.5478")), "b": (None, D("1.0000"))}


def test_a_grid_must_not_end_before_it_starts():
    with pytest.raises(ValueError, match="before its start"):
        Grid("2024-01-02 00:00:00", "2024-01-01 00:00:00")


def test_more_entities_get_more_tasks(spark, monkeypatch):
    from hourstar.operators import grid as module

    monkeypatch.setattr(module, "ROWS_PER_TASK", 1000)
    day = Grid("2024-01-01 00:00:00", "2024-01-10 23:00:00")
    tasks = [hourly_spine(spark.range(n).select(F.col("id").alias("e")), "e", day).rdd.getNumPartitions() for n in (10, 1000)]
    assert tasks[0] == 4 and tasks[1] == 240


def test_nothing_generated_is_shuffled_and_no_exchange_is_by_the_entity_alone(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        readings = spark.range(40).select(
            (F.col("id") % 2).cast("string").alias("e"), F.expr("timestamp'2024-01-01' + make_interval(0,0,0,0,id div 2 * 3)").alias("t"),
            F.when(F.col("id") % 5 > 0, F.col("id").cast("decimal(10,1)")).alias("v"))
        entities = spark.createDataFrame([("0",), ("1",), ("2",)], "e STRING")
        day = Grid("2024-01-01 00:00:00", "2024-01-03 23:00:00", chunk=24)
        means = series.entity_mean(readings, "e", {"v": 1})
        fused = series.align(entities, readings, "e", "t", day, means=means, columns=["v"])
        steps = series.impute(series.align(entities, readings, "e", "t", day), means, "e", ["v"])
        assert sorted(map(str, fused.collect())) == sorted(map(str, steps.collect()))
        assert fused.count() >= 3 * 72
        lines = fused._jdf.queryExecution().executedPlan().toString().splitlines()
        depth = [len(re.match(r"[\s:+\-|]*", line).group()) for line in lines]
        at = next(i for i, line in enumerate(lines) if "Generate explode(sequence((_slot" in line)
        above, level = [], depth[at]
        for i in range(at - 1, -1, -1):
            if depth[i] < level:
                above.append(lines[i])
                level = depth[i]
        assert above and not any("Exchange" in line or "Join" in line for line in above)
        joins = [line for line in lines if "Join" in line and "_chunk" in line]
        assert joins and all("e#" in line for line in joins)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rolling_mean_takes_running_sums_and_rounds_as_avg(spark):
    from pyspark.sql import Window

    rows = spark.range(0, 3000, 1, 3).select(
        (F.col("id") % 3).alias("e"), (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=(F.col("id") / 3).cast("int"))).alias("t"),
        F.when((F.col("id") % 7 > 1) & (F.col("id") > 90), ((F.hash("id") % 100_003) / 10).cast("decimal(10,1)")).alias("v"))
    grid = Grid("2024-01-01 00:00:00", "2024-02-11 15:00:00", chunk=100)
    out = series.rolling_mean(rows, "e", "t", "v", grid, out="mean")
    frame = Window.partitionBy("e").orderBy("t").rowsBetween(-23, 0)
    want = rows.withColumn("mean", F.avg("v").over(frame).cast("decimal(10,1)"))
    assert out.schema["mean"].dataType == want.schema["mean"].dataType
    assert out.select(want.columns).exceptAll(want).isEmpty() and out.count() == 3000
    assert out.where("mean IS NULL").count() > 0 and out.where("mean < 0").count() > 0
    assert "-23" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_conditions_on_the_rolling_mean_do_not_repeat_its_arithmetic(spark):
    rows = spark.range(100).selectExpr("0 AS e", "timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,id) AS t", "cast(id AS decimal(10,1)) AS v", "id AS o")
    out = series.complete_series(rows, rows.select("e"), entity="e", time="t", value="v", order="o",
                                 grid=Grid("2024-01-01 00:00:00", "2024-01-05 03:00:00"), rolling="m")
    few = out.where("m > 3 AND m < 90 AND m IS NOT NULL")
    assert few._jdf.queryExecution().optimizedPlan().toString().count("* 20000") <= 1
    assert few.count() == out.count() - out.where("m <= 3 OR m >= 90").count()
