"""Lists, documents, files and typed tables."""

import pytest
from pyspark.sql import functions as F

from hourstar.functions.values import epoch_seconds
from hourstar.schemas import STAR
from hourstar.session import build_session, shared_dir
from hourstar.sources import landing, lists, tables


def test_entity_list_renames_and_keeps_one_column(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,ADM1_EN,area\n1,Bangkok,1.5\n2,Chiang Mai,2\n")
    df = lists.entity_list(spark, str(tmp_path / "p.csv"))
    assert df.columns == ["province_name"]
    assert sorted(r[0] for r in df.collect()) == ["Bangkok", "Chiang Mai"]
    typed = lists.entity_list(spark, str(tmp_path / "p.csv"), schema="id INT, ADM1_EN STRING, area DOUBLE")
    assert sorted(r[0] for r in typed.collect()) == ["Bangkok", "Chiang Mai"]


def test_coordinates(spark, tmp_path):
    (tmp_path / "c.csv").write_text("province_id,province_name,latitude,longitude\n3,Bangkok,13.7525,100.4935\n")
    [row] = lists.coordinates(spark, str(tmp_path / "c.csv")).collect()
    assert (row.province_id, row.province_name, str(row.latitude), str(row.longitude)) == (
        3, "Bangkok", "13.7525", "100.4935")


def test_names_from_a_parameter(spark):
    assert [r[0] for r in lists.entities_from_text(spark, "Bangkok,Chiang Mai").collect()] == ["Bangkok", "Chiang Mai"]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Bangkok", "America/New_York"])
def test_epoch_of_a_wall_time_does_not_depend_on_the_session(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.range(1).select(
            epoch_seconds(F.lit("2021-01-01 00:00:00"), "Asia/Bangkok").alias("text"),
            epoch_seconds(F.expr("timestamp_ntz'2021-03-14 02:30:00'"), "UTC").alias("ntz")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (1609434000, 1615689000)


def test_documents_are_bounded_and_hold_every_copy(spark, monkeypatch):
    monkeypatch.setattr(landing, "MAX_READINGS", 64)
    rows = spark.range(0, 3000, 1, 3).select(
        F.when(F.col("id") < 1000, "copies").when(F.col("id") < 2500, "hot").otherwise("thin").alias("e"),
        F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("v"))
    docs = landing.nest(rows, "e", "items", [F.col("v")], ["v"])
    sizes = docs.select(F.size("items").alias("n")).collect()
    assert max(r.n for r in sizes) <= 64 and sum(r.n for r in sizes) == 3000
    back = docs.select("e", F.explode("items").alias("i")).select("e", "i.v")
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    unsorted = docs.filter(F.sort_array(F.col("items.v")) != F.col("items.v"))
    assert unsorted.isEmpty()


def test_empty_and_missing_documents(spark):
    docs = spark.createDataFrame([("a", []), ("b", None)], "province_name STRING, list ARRAY<STRUCT<components: "
                                 "STRUCT<pm2_5: DECIMAL(10,2)>, dt: BIGINT>>").withColumn(
        "coord", F.expr("struct(cast(1 as decimal(10,4)) as lon, cast(2 as decimal(10,4)) as lat)"))
    assert landing.explode_readings(docs).count() == 0
    assert landing.explode_readings(docs, keep_empty=True).count() == 2


def test_files_are_capped_by_rows_and_compact_tables_get_one_file(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4)
    tables.write_table(df, str(tmp_path / "many"), max_records=100)
    tables.write_table(df, str(tmp_path / "one"), compact=True)
    assert len(list((tmp_path / "many").glob("part-*"))) == 12
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    tables.write_table(df.limit(3), str(tmp_path / "many"))
    assert tables.read_table(spark, str(tmp_path / "many"), {"id": "BIGINT"}).count() == 3


def test_typed_tables_are_recreated_and_loaded_by_position(spark, tmp_path):
    tables.setup_star(spark, "report_t", str(tmp_path / "w"), STAR)
    hours = spark.range(24).select(F.lpad(F.col("id").cast("string"), 2, "0").alias("a"), F.col("id").alias("b"))
    tables.load_by_position(hours, "report_t.dim_time")
    tables.load_by_position(hours, "report_t.dim_time")
    assert spark.table("report_t.dim_time").count() == 24
    assert spark.table("report_t.dim_time").dtypes == [("time_key", "varchar(2)"), ("hour", "int")] or \
        spark.table("report_t.dim_time").dtypes == [("time_key", "string"), ("hour", "int")]
    with pytest.raises(ValueError):
        tables.load_by_position(hours.select("a"), "report_t.dim_time")
    with pytest.raises(ValueError):
        tables.load_columns(hours, "report_t.dim_time", ["a", "b"])
    renamed = hours.select(F.col("b").alias("hour"), F.col("a").alias("time_key"))
    tables.load_columns(renamed, "report_t.dim_time", ["hour", "time_key"])
    assert spark.table("report_t.dim_time").filter("time_key = '07' and hour = 7").count() == 1
    with pytest.raises(Exception):
        tables.load_by_position(spark.createDataFrame([("000", 1)], "a STRING, b INT"), "report_t.dim_time")
    nulls = spark.createDataFrame([("01", None)], "a STRING, b INT")
    with pytest.raises(Exception, match="hour must not be null"):
        tables.load_by_position(nulls, "report_t.dim_time", STAR["dim_time"])
    tables.setup_star(spark, "report_t", str(tmp_path / "w"), STAR)
    assert spark.table("report_t.dim_time").count() == 0


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert build_session(time_zone="UTC") is not None


def test_documents_move_once(spark):
    rows = spark.range(1000).select(F.lit("a").alias("e"), "id", F.when(F.col("id") % 3 > 0, F.lit(1.5)).alias("h"))
    docs = landing.nest(rows, "e", "items", [F.col("id")], ["id"], ["h"])
    assert docs._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {(r.h, len(r["items"])) for r in docs.groupBy("h").agg(F.flatten(F.collect_list("items")).alias("items")).collect()} == {
        (None, 334), (1.5, 666)}
    assert landing.nest(rows.where("false"), "e", "items", [F.col("id")], ["id"]).count() == 0
    nulls = landing.nest(rows.withColumn("e", F.lit(None).cast("string")), "e", "items", [F.col("id")], ["id"])
    assert nulls.agg(F.sum(F.size("items"))).first()[0] == 1000


def test_documents_go_on_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows = spark.range(10_000).select((F.col("id") >= 9000).alias("e"), "id")
        docs = landing.nest(rows.coalesce(1), "e", "items", [F.col("id")], ["id"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(i.id for d in docs for i in d["items"]) == list(range(10_000))
    assert len(docs) <= 4 + 3 + 4  # full ones, and one more for each of the tasks' ends


def landed_docs(spark, names):
    return spark.createDataFrame([(n, i, k) for i, n in enumerate(names) for k in range(3)], "province_name STRING, i INT, k LONG").selectExpr(
        "province_name", "struct(cast(i as decimal(10,4)) as lon, cast(2 as decimal(10,4)) as lat) AS coord",
        "array(struct(struct(cast(k as decimal(10,2)) as pm2_5) as components, k as dt)) AS list")


@pytest.mark.parametrize("layout", ["file", "folder"])
def test_files_in_a_mounted_store_are_named_by_tasks(spark, tmp_path, monkeypatch, layout):
    """No file passes Spark's writer, whose commit moves each in the driver, and folders are as Spark's writer names them."""
    names = ["Station 1", "A+B 100%", "x=y'#*?", "back\\slash [1]^{2}"]
    docs, path = landed_docs(spark, names), str(tmp_path / "landed")
    old = tmp_path / "old"
    docs.write.partitionBy("province_name").json(str(old))
    with monkeypatch.context() as m:
        m.setattr(type(docs.write), "json", lambda *a, **k: pytest.fail("written by Spark's writer"))
        for _ in range(2):  # the second time over the first
            landing.land(docs, path, layout=layout)
    if layout == "folder":
        assert {p.name for p in (tmp_path / "landed").iterdir()} == {p.name for p in old.glob("province_name=*")}
    rows = landing.explode_readings(landing.read_landed(spark, path, layout=layout))
    assert {r[0]: r[1] for r in rows.groupBy("province_name").count().collect()} == dict.fromkeys(names, 3)
    assert not [p for p in tmp_path.rglob("*") if "-landing-" in p.name or p.name.startswith(".")
                and not p.name.endswith(".crc") and old not in p.parents]


def test_pretty_documents_are_added_to_folders(spark, tmp_path):
    path = str(tmp_path / "landed")
    landing.land(landed_docs(spark, ["a", None]), path, layout="folder", pretty=True, append=True)
    landing.land(landed_docs(spark, ["b", ""]), path, layout="folder", append=True)
    assert {p.name for p in (tmp_path / "landed").iterdir()} == {
        "province_name=a", "province_name=b", "province_name=__HIVE_DEFAULT_PARTITION__"}
    assert "\n  " in next((tmp_path / "landed" / "province_name=a").glob("*.json")).read_text()
    with pytest.raises(ValueError, match="cannot be added"):
        landing.land(landed_docs(spark, ["a"]), path, layout="file", append=True)


def test_landing_lists_folders_with_few_tasks(spark, tmp_path):
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, path = spark.conf.get(key), str(tmp_path / "landed")
    landing.land(landed_docs(spark, [f"P{k}" for k in range(150)]), path, layout="folder")
    spark.sparkContext.setJobGroup("listing", "")
    landing.read_landed(spark, path, layout="folder")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert 0 < max(tracker.getStageInfo(s).numTasks for s in stages) <= 32
    assert spark.conf.get(key) == before
