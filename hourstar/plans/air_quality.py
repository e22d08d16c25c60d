"""The air-quality job: landed documents to an audited, published star schema."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourstar import schemas
from hourstar.functions.aqi import with_aqi
from hourstar.operators.grid import Grid
from hourstar.operators.quality import Measured, gate, scan, star_foreign_keys, star_rules
from hourstar.operators.series import clean_readings, complete_series
from hourstar.operators.star import dim_date, dim_entity, dim_time, fact, with_period
from hourstar.operators.keys import enrich
from hourstar.session import stored
from hourstar.sources.landing import (
    between_epochs, explode_readings, land, landed_files, landing_status, read_landed, reading_documents, require_all,
    with_broken_files,
)
from hourstar.sources.tables import declared, point_view, read_table, write_split, write_table

ENTITY, TIME, KEY = "province_name", "datetime", "province_id"
# Coordinates are filled like the value, to four decimals.
COORDINATES = {"latitude": 4, "longitude": 4}


@dataclass(frozen=True)
class Job:
    """Where the documents lie and how they are keyed, where the star goes, and the closed range of hours.

    ``record_id_type`` is INT as declared; use ``bigint`` where the fact can pass 2^31 rows. ``period``, year, month or
    day, splits the fact's files by time; the published fact then has a column ``period`` for ``star_join``.
    """

    raw: str
    out: str
    start: str
    end: str
    layout: str = "file"
    record_id_type: str = "int"
    database: str | None = None
    period: str | None = None

    @property
    def star(self) -> dict[str, dict[str, str]]:
        tables = {t: dict(c) for t, c in schemas.STAR.items()}
        tables["fact_air_quality"]["record_id"] = f"{self.record_id_type.upper()} NOT NULL"
        return tables


def hourly_series(readings: DataFrame, provinces: DataFrame, start: str, end: str,
                  n_provinces: int | None = None) -> DataFrame:
    """Complete hourly series of all provinces, with the 24-hour mean.

    Of several readings of one hour the lowest is kept; the province mean counts all of them.
    """
    series = complete_series(
        readings, provinces, entity=ENTITY, time=TIME, value="pm2_5", order="pm2_5", grid=Grid(start, end),
        attributes=COORDINATES, rows=24, rolling="pm2_5_24h_avg", n_entities=n_provinces,
    )
    return series.select(TIME, "latitude", "longitude", ENTITY, "pm2_5", "pm2_5_24h_avg")


def hourly_aqi(series: DataFrame) -> DataFrame:
    """One row per province and hour with its index; the 24-hour mean is not kept."""
    return with_aqi(series, "pm2_5_24h_avg").select(TIME, "latitude", "longitude", ENTITY, "pm2_5", "aqi")


def extract(readings: DataFrame, provinces: DataFrame, coordinates: DataFrame, start: int, end: int, path: str,
            layout: str = "field") -> None:
    """Land the readings (``province_name, dt, pm2_5``) of the listed provinces between two Unix times, both inclusive.

    Every province gets its coordinates, those of the smallest id where a name is listed twice, and
    its readings become documents below ``path``.
    """
    listed = between_epochs(readings, "dt", start, end).join(provinces.select(ENTITY).distinct(), ENTITY, "left_semi")
    placed = enrich(listed, coordinates, ENTITY, KEY, list(COORDINATES))
    # Documents are cut by place in the input, which is the same in every try only if it is stored.
    land(reading_documents(stored(placed, "placed"), by_day=layout == "day"), path, layout=layout)


def numbered_fact(aqi: DataFrame, provinces: DataFrame, start: str, end: str, record_id_type: str) -> DataFrame:
    """The fact with ``record_id`` 1..N in the order of hour and province.

    The series is complete, so the number follows from the hour's slot and the province's number by
    arithmetic: no pass for ordering, no second copy.
    """
    n = provinces.agg(F.coalesce(F.max(KEY), F.lit(0))).first()[0]
    number = Grid(start, end).slot_of(F.col("_time")).cast("long") * n + F.col(KEY)
    rows = fact(aqi.withColumn("_time", F.col(TIME)), provinces, ENTITY, TIME, KEY, ["_time", "pm2_5", "aqi"])
    rows = rows.withColumn("record_id", number.cast(record_id_type)).drop("_time")
    columns = ["record_id", *(c for c in rows.columns if c != "record_id")]
    return rows.select(*columns)


def build(spark: SparkSession, provinces: DataFrame, job: Job, n_provinces: int | None = None,
          measured: Mapping[str, Measured] | None = None) -> str:
    """Build the star in a new version folder and return its path. ``measured`` takes its metrics of each table as it is written.

    The JSON is parsed once into a columnar table, broken files a second time as a whole, and the hourly index is stored before the four
    tables read it. Everything a later step needs lies in the output folder, so a lost executor
    costs its own tasks only.
    """
    version = f"{job.out.rstrip('/')}/versions/{uuid.uuid4().hex}"
    docs = read_landed(spark, job.raw, ENTITY, job.layout, files=True)
    write_table(explode_readings(docs, ENTITY, keep_empty=True), f"{version}/readings")
    readings = spark.read.schema(f"{schemas.READINGS}, file STRING").parquet(f"{version}/readings")
    readings = with_broken_files(spark, readings, job.raw, f"{version}/recovered", ENTITY, job.layout)
    write_table(landing_status(provinces, readings, ENTITY), f"{version}/landing", compact=True)
    landed = spark.read.parquet(f"{version}/landing").filter("status <> 'missing'")
    require_all(provinces, landed, ENTITY, version)

    cleaned = clean_readings(readings, "pm2_5")
    series = hourly_series(cleaned, provinces, job.start, job.end, n_provinces)
    write_table(hourly_aqi(series), f"{version}/hourly_aqi")
    aqi = spark.read.parquet(f"{version}/hourly_aqi")

    def write(name: str, table: DataFrame) -> None:
        observe = measured[name].observe if measured else None
        rows, path = declared(table, job.star[name]), f"{version}/{name}"
        if name.startswith("dim_"):
            write_table(rows, path, compact=True, observe=observe)
        elif job.period:
            write_split(with_period(rows, job.period), path, "period", ["record_id"], observe=observe)
        else:
            # Files hold ranges of the number, so row-group statistics prune by date.
            write_table(rows.repartitionByRange("record_id").sortWithinPartitions("record_id"), path, observe=observe)

    write("dim_province", dim_entity(aqi, ENTITY, KEY, list(COORDINATES), scratch=version))
    write("dim_date", dim_date(aqi, TIME))
    write("dim_time", dim_time(aqi, TIME))
    stored_provinces = read_table(spark, f"{version}/dim_province", job.star["dim_province"])
    write("fact_air_quality", numbered_fact(aqi, stored_provinces, job.start, job.end, job.record_id_type))
    return version


def open_star(spark: SparkSession, version: str, job: Job) -> dict[str, DataFrame]:
    split = {"fact_air_quality": {"period": "STRING"}} if job.period else {}
    return {t: read_table(spark, f"{version}/{t}", {**columns, **split.get(t, {})}) for t, columns in job.star.items()}


def audit(spark: SparkSession, version: str, job: Job, n_provinces: int, measured: Mapping[str, Measured] | None = None) -> DataFrame:
    """Store and return the verdicts of all rules and foreign keys."""
    tables = {t: df.drop("period") for t, df in open_star(spark, version, job).items()}
    rules = star_rules(n_provinces, job.record_id_type)
    verdicts = scan(tables, rules, measured).unionByName(star_foreign_keys(tables))
    write_table(verdicts, f"{version}/audit", compact=True)
    return spark.read.parquet(f"{version}/audit")


def publish(spark: SparkSession, version: str, job: Job) -> None:
    """Make a version the current one. Only metadata changes; no data is copied and nothing is deleted.

    The release is one new marker file: until it is there, the version before stays current, and
    afterwards this one is. Names in a catalog are then replaced one by one, dimensions first.
    """
    release = spark.createDataFrame([(time.time_ns(), version)], "published LONG, version STRING").coalesce(1)
    release.write.json(f"{job.out.rstrip('/')}/releases/{version.rsplit('/', 1)[1]}")
    if job.database:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {job.database}")
        for table, columns in job.star.items():
            point_view(spark, f"{job.database}.{table}", columns, f"{version}/{table}")


def published(spark: SparkSession, job: Job) -> dict[str, DataFrame]:
    """The current version's tables."""
    releases = spark.read.schema("published LONG, version STRING").json(f"{job.out.rstrip('/')}/releases/*")
    version = releases.agg(F.max_by("version", "published")).first()[0]
    return open_star(spark, version, job)


def run(spark: SparkSession, provinces: DataFrame, job: Job) -> DataFrame:
    """Check the landing, build, audit, and publish only if every rule passes. Returns the verdicts."""
    if job.layout in ("file", "folder"):
        # The listing alone shows what is missing, before anything is parsed.
        require_all(provinces, landed_files(spark, job.raw, ENTITY, job.layout), ENTITY, job.out)
    n_provinces = provinces.select(ENTITY).distinct().count()
    measured = {table: Measured(rules) for table, rules in star_rules(n_provinces, job.record_id_type).items()}
    version = build(spark, provinces, job, n_provinces, measured)
    verdicts = gate(audit(spark, version, job, n_provinces, measured))
    publish(spark, version, job)
    return verdicts
