"""Keys, lookups, dimensions, fact and reports."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from hourstar.operators import keys, star
from hourstar.plans import reports
from hourstar.sources import tables


def test_dense_key_numbers_in_order_whatever_the_layout(spark):
    df = spark.range(0, 5000, 1, 7).select(((F.col("id") * 7919) % 5000).alias("v"))
    # Most rows share the first column, so only the second one can spread them.
    df = df.withColumn("hot", F.when(F.col("v") < 4000, 1).otherwise(F.col("v").cast("int")))
    rows = keys.dense_key(df, ["hot", "v"], "k").orderBy("k").collect()
    assert [r.k for r in rows] == list(range(1, 5001))
    assert [(r.hot, r.v) for r in rows] == sorted((r.hot, r.v) for r in rows)


def test_dense_key_of_nothing(spark):
    assert keys.dense_key(spark.createDataFrame([], "v INT"), ["v"], "k").collect() == []


def test_dense_key_refuses_to_overflow(spark):
    df = spark.range(300)
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        keys.dense_key(df, ["id"], "k", "tinyint").collect()


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_lookup_join_is_the_same_whatever_the_planner_may_broadcast(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        left = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
        right = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
        joined = keys.lookup_join(left, right, "k")
        assert ("BroadcastHashJoin" in joined._jdf.queryExecution().toString()) == (threshold != "-1")
        assert joined.count() == 72
        assert keys.lookup_join(left, right, "k", "left").filter("v is null").count() == 28
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ties_keep_the_same_row_in_any_layout(spark):
    rows = [(k, 1, a, 9.0 - a) for k in range(5) for a in (3.5, 0.5, 1.5, 2.5)]
    df = spark.createDataFrame(rows, "k INT, v INT, a DOUBLE, b DOUBLE")
    kept = [
        sorted(tuple(r) for r in keys.first_row(df.orderBy(F.rand(seed)).repartition(n), ["k"], "v").collect())
        for seed, n in ((1, 1), (2, 4), (3, 8))
    ]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 5


def test_enrich_takes_the_first_match_only(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "name STRING")
    coords = spark.createDataFrame([("a", 2, 1.0), ("a", 1, 2.0), ("b", 5, 3.0)], "name STRING, rank INT, lat DOUBLE")
    assert {r.name: r.lat for r in keys.enrich(df, coords, "name", "rank", ["lat"]).collect()} == {
        "a": 2.0, "b": 3.0, "c": None}


@pytest.fixture
def hourly(spark):
    rows = [
        ("Trat", "2023-12-31 23:00:00", "12.0", 50, "7.0"), ("Trat", "2024-01-01 00:00:00", "20.0", 68, "7.0"),
        ("Bangkok", "2024-01-01 00:00:00", "100.0", 174, "13.0"), ("Bangkok", "2024-01-06 05:00:00", "10.0", 42, "13.0"),
        ("Bangkok", "2024-01-06 06:00:00", "10.1", 42, "12.9"),
    ]
    df = spark.createDataFrame(rows, "name STRING, t STRING, pm STRING, aqi INT, lat STRING")
    return df.select("name", F.to_timestamp("t").alias("t"), F.col("pm").cast("decimal(10,1)").alias("pm2_5"), "aqi",
                     F.col("lat").cast("decimal(10,4)").alias("lat"))


def test_dimensions(spark, hourly):
    provinces = star.dim_entity(hourly, "name", "id", ["lat"])
    assert [tuple(r) for r in provinces.orderBy("id").collect()] == [
        (1, "Bangkok", Decimal("12.9000")), (2, "Trat", Decimal("7.0000"))]
    days = star.dim_date(hourly, "t").orderBy("date").collect()
    assert tuple(days[0]) == ("20231231", date(2023, 12, 31), 2023, 4, 12, 31, "Sun", date(2023, 1, 1),
                              date(2023, 10, 1), date(2023, 12, 1))
    assert [d.date_key for d in days] == ["20231231", "20240101", "20240106"]
    assert [tuple(r) for r in star.dim_time(hourly, "t").orderBy("hour").collect()] == [
        ("00", 0), ("05", 5), ("06", 6), ("23", 23)]


def test_fact_and_reports(spark, hourly):
    provinces, dates, times = star.dim_entity(hourly, "name", "id"), star.dim_date(hourly, "t"), star.dim_time(hourly, "t")
    facts = star.fact(hourly, provinces, "name", "t", "id", ["pm2_5", "aqi"])
    assert facts.columns == ["record_date", "record_time", "id", "pm2_5", "aqi"]
    assert star.star_join(facts, dates, times, provinces, "id").count() == 5
    months = {r.month: r for r in reports.monthly_profile(facts, dates).collect()}
    assert months[1].avg_pm2_5 == Decimal("35.03") and months[1].hours == 4 and months[1].max_aqi == 174
    assert [r.month for r in reports.monthly_profile(facts, dates).collect()] == [1, 12]
    assert [r.start_of_month for r in reports.monthly_trend(facts, dates).collect()] == [
        date(2023, 12, 1), date(2024, 1, 1)]
    kinds = {r.day_kind: r.avg_pm2_5 for r in reports.weekday_weekend(facts, dates).collect()}
    assert kinds == {"weekend": Decimal("10.70"), "weekday": Decimal("60.00")}
    assert [r.name for r in reports.top_entities(facts, provinces, "id", "name", 1).collect()] == ["Bangkok"]
    assert {r.severity: r.hours for r in reports.severity_distribution(facts).collect()} == {
        "Good": 3, "Moderate": 1, "Unhealthy": 1}
    assert {r.hour: r.hours for r in reports.hour_profile(facts, times).collect()} == {0: 2, 5: 1, 6: 1, 23: 1}
    regions = spark.createDataFrame([("Bangkok", "Central"), ("Trat", "East")], "name STRING, region STRING")
    assert {r.region: r.hours for r in reports.regional(facts, provinces, "id", "name", regions).collect()} == {
        "Central": 3, "East": 2}
    loose = spark.createDataFrame([("Bangkok", "South"), ("Bangkok", "Central")], "name STRING, region STRING")
    assert {r.region: r.hours for r in reports.regional(facts, provinces, "id", "name", loose).collect()} == {
        "Central": 3, "unknown": 2}


def scanned(df):
    """How many files the scans of a plan open, from the metrics of the run."""
    from pyspark.sql.classic.dataframe import DataFrame

    assert isinstance(df, DataFrame)
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    found, todo = {}, [plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if node.metrics().contains("numFiles"):
            roots = node.relation().location().rootPaths()
            found[roots.apply(0).getName()] = node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


@pytest.mark.parametrize(("period", "files"), [("day", 2), ("month", 1), ("year", 1)])
def test_periods_of_the_dates_select_the_files(spark, tmp_path, period, files):
    hours = spark.range(24 * 80).select(
        F.timestamp_seconds(F.lit(1701388800) + F.col("id") * 3600).alias("t"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("name"),
        F.col("id").cast("int").alias("aqi"))
    entities, dates, times = star.dim_entity(hours, "name", "id"), star.dim_date(hours, "t"), star.dim_time(hours, "t")
    facts = star.with_period(star.fact(hours, entities, "name", "t", "id", ["aqi"]), period)
    path = str(tmp_path / "fact")
    tables.write_split(facts, path, "period", ["record_time", "id"])
    dates.write.parquet(str(tmp_path / "dates"))
    back = spark.read.schema(facts.schema).parquet(path)
    wanted = spark.read.parquet(str(tmp_path / "dates")).where("date in (date'2024-02-10', date'2024-02-11')")
    joined = star.star_join(back, wanted, times, entities, "id", period=period)
    whole = star.star_join(facts.drop("period"), wanted, times, entities, "id")
    assert joined.columns == whole.columns
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, whole.collect())) and whole.count() == 96
    assert scanned(joined)["fact"] == files < len(list((tmp_path / "fact").glob("period=*")))


def test_split_tables_keep_nulls_cut_hot_values_and_refuse_empty_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "b"), (4, "a/ %")], "v INT, p STRING")
    tables.write_split(df, path, "p", ["v"])
    assert sorted(map(tuple, spark.read.schema(df.schema).parquet(path).collect())) == sorted(map(tuple, df.collect()))
    tables.write_split(df.limit(0), path, "p")
    assert spark.read.schema(df.schema).parquet(path).count() == 0
    with pytest.raises(Exception, match="must not be empty"):
        tables.write_split(df.fillna(""), path, "p")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        hot = spark.range(400_000).select(F.xxhash64("id").alias("v"), F.when(F.col("id") % 1000 > 0, "hot").otherwise("cold").alias("p"))
        tables.write_split(hot.repartition(16), path, "p", ["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "p=hot").glob("part-*"))) > 4
    assert spark.read.parquet(path).count() == 400_000


def test_a_large_dimension_is_hashed_and_the_fact_not_sorted(spark, tmp_path):
    """Sorting its share of the fact took most of a task's memory."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        hours = spark.range(2000).selectExpr(
            "concat('S', id % 50) AS station", "timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,id) AS datetime", "id AS v")
        star.dim_entity(hours, "station", "station_id").write.parquet(str(tmp_path / "dim"))
        dim = spark.read.parquet(str(tmp_path / "dim"))
        fact = star.fact(hours, dim, "station", "datetime", "station_id", ["v"])
        joined = star.star_join(fact, star.dim_date(hours, "datetime"), star.dim_time(hours, "datetime"), dim, "station_id")
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("ShuffledHashJoin") == 2
        assert joined.join(hours, ["station", "v"]).count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
