"""One query per operator. Every query reads whole tables.

``events`` plays the sensor stream: a user is a station, an event's hour the reading's hour and its
value the concentration. The range of hours comes from the data.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourstar import schemas
from hourstar.functions import aqi
from hourstar.functions.values import epoch_seconds, mean_of, round_reading, split_list, wall_seconds
from hourstar.operators import appends, increments, intervals, quality, series, star
from hourstar.operators.grid import Grid, hourly_spine
from hourstar.operators.keys import dense_key, enrich
from hourstar.plans import air_quality, reports
from hourstar.session import empty_table, scratch_path, stored
from hourstar.sources import landing, lists, tables

Query = Callable[[SparkSession, str], DataFrame]
ZONE = "Asia/Bangkok"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- events as a sensor stream -------------------------------------------------------------------

class Stream:
    """The events as readings; the table is opened once."""

    def __init__(self, spark: SparkSession, sf: str):
        self.events = table(spark, sf, "events")

    def readings(self) -> DataFrame:
        rows = self.events.select(
            "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("datetime"), "event_id", "value"
        )
        return series.clean_readings(rows, "value")

    def stations(self) -> DataFrame:
        return self.events.select("user_id").distinct()

    def grid(self) -> Grid:
        """From the hour of the first event to the hour of the last."""
        ends = [F.date_format(F.date_trunc("hour", end("ts")), "yyyy-MM-dd HH:mm:ss") for end in (F.min, F.max)]
        return Grid(*self.events.agg(*ends).first())

    def unique(self) -> DataFrame:
        return series.dedup(self.readings(), ["user_id", "datetime"], "event_id")

    def means(self) -> DataFrame:
        return series.entity_mean(self.readings(), "user_id", {"value": 1})

    def spine(self) -> DataFrame:
        return hourly_spine(self.stations(), "user_id", self.grid(), time_type="timestamp_ntz")

    def aligned(self) -> DataFrame:
        return series.align(self.stations(), self.readings(), "user_id", "datetime", self.grid())

    def imputed(self) -> DataFrame:
        return series.align(
            self.stations(), self.readings(), "user_id", "datetime", self.grid(), means=self.means(), columns=["value"]
        ).drop("event_id")

    def rolled(self) -> DataFrame:
        """De-duplicated, aligned, imputed and rolled, one operator at a time."""
        hours = self.grid()
        filled = series.align(
            self.stations(), self.unique(), "user_id", "datetime", hours, means=self.means(), columns=["value"]
        ).drop("event_id")
        return series.rolling_mean(filled, "user_id", "datetime", "value", hours, out="value_24h")

    def complete(self) -> DataFrame:
        """The same in one fused plan."""
        return series.complete_series(
            self.readings(), self.stations(), entity="user_id", time="datetime", value="value", order="event_id",
            grid=self.grid(), rolling="value_24h",
        )

    def by_batches(self) -> DataFrame:
        """The same kept up to date: the first four fifths of the time, then the rest, by which the grid grows."""
        whole, spark = self.grid(), self.events.sparkSession
        state = scratch_path(spark, "series")
        bounds = self.events.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
        early = F.unix_micros(F.col("ts").cast("timestamp")) < bounds[0] + (bounds[1] - bounds[0]) * 4 // 5
        for name, rows in (("first", early), ("second", ~early)):
            part = Stream.__new__(Stream)
            part.events = self.events.where(rows)
            increments.add_batch(
                state, name, part.readings(), part.stations(), entity="user_id", time="datetime", value="value", order="event_id",
                grid=Grid(whole.start, part.grid().end), rolling="value_24h")
        return increments.current_series(
            spark, state, entity="user_id", entity_type="bigint", time="datetime", value="value", value_type="decimal(10,1)", grid=whole,
            time_type="timestamp_ntz", rolling="value_24h")

    def hourly_aqi(self) -> DataFrame:
        return aqi.with_aqi(self.complete(), "value_24h")


def concentrations(spark: SparkSession, sf: str) -> DataFrame:
    """Doubled values, so that some lie above the last band."""
    doubled = round_reading(F.col("value") * 2)
    return table(spark, sf, "events").select("event_id", doubled.alias("concentration"))


# --- star schema from the events -----------------------------------------------------------------

class EventStar:
    """The star of the events; each table is built when it is first asked for."""

    def __init__(self, spark: SparkSession, sf: str):
        named = Stream(spark, sf).hourly_aqi().select(
            F.col("user_id").cast("string").alias("station"), "datetime", F.col("value").alias("pm2_5"), "aqi"
        )
        self.aqi = stored(named, "hourly-aqi")

    @cached_property
    def stations(self) -> DataFrame:
        return stored(star.dim_entity(self.aqi, "station", "station_id"), "stations")

    @cached_property
    def dates(self) -> DataFrame:
        return star.dim_date(self.aqi, "datetime")

    @cached_property
    def times(self) -> DataFrame:
        return star.dim_time(self.aqi, "datetime")

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact(self.aqi, self.stations, "station", "datetime", "station_id", ["pm2_5", "aqi"])


def star_join(spark: SparkSession, sf: str) -> DataFrame:
    s = EventStar(spark, sf)
    return star.star_join(s.fact, s.dates, s.times, s.stations, "station_id")


def star_join_period(spark: SparkSession, sf: str) -> DataFrame:
    """The fact's files are split by day; those of the weekends' days are opened."""
    s = EventStar(spark, sf)
    path = scratch_path(spark, "fact")
    tables.write_split(star.with_period(s.fact, "day"), path, "period", ["record_time", "station_id"])
    fact = spark.read.schema(s.fact.withColumn("period", F.lit("")).schema).parquet(path)
    weekends = stored(s.dates, "dates").where(F.col("day_of_week").isin("Sat", "Sun"))
    return star.star_join(fact, weekends, s.times, s.stations, "station_id", period="day")


def user_regions(spark: SparkSession, sf: str, which: str = "true") -> DataFrame:
    customers = table(spark, sf, "customer").where(which).select(F.col("c_custkey").cast("string").alias("station"), "c_nationkey")
    nations = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    regions = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return customers.join(nations, "c_nationkey").join(regions, "n_regionkey").select(
        "station", F.col("r_name").alias("region")
    )


def stream(make: Callable[[Stream], DataFrame]) -> Query:
    return lambda spark, sf: make(Stream(spark, sf))


def report(make: Callable[[EventStar], DataFrame]) -> Query:
    return lambda spark, sf: make(EventStar(spark, sf))


def report_region(spark: SparkSession, sf: str) -> DataFrame:
    s = EventStar(spark, sf)
    regions = stored(user_regions(spark, sf), "regions")
    return reports.regional(s.fact, s.stations, "station_id", "station", regions)


def report_region_partial(spark: SparkSession, sf: str) -> DataFrame:
    """Some stations have no region and some have two."""
    s = EventStar(spark, sf)
    regions = user_regions(spark, sf, "c_nationkey % 3 <> 0")
    twice = user_regions(spark, sf, "c_nationkey % 3 <> 0 AND c_nationkey % 4 = 1").withColumn("region", F.lit("ASIA"))
    return reports.regional(s.fact, s.stations, "station_id", "station", regions.unionByName(twice))


# --- documents -----------------------------------------------------------------------------------

def station_name(user_id: str) -> Column:
    return F.concat(F.lit("Station "), F.col(user_id).cast("string"))


def flat_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the columns of the raw documents."""
    user = F.col("user_id")
    return table(spark, sf, "events").select(
        station_name("user_id").alias("province_name"),
        (F.lit(5) + user % 15).cast("decimal(10,4)").alias("latitude"),
        (F.lit(97) + user % 8).cast("decimal(10,4)").alias("longitude"),
        wall_seconds(F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("dt"),
        F.col("value").cast("decimal(10,2)").alias("pm2_5"),
    )


def landed_path(spark: SparkSession, sf: str, layout: str) -> str:
    path = scratch_path(spark, "landed")
    landing.land(landing.reading_documents(flat_readings(spark, sf)), path, layout=layout)
    return path


def landing_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    docs = landing.read_landed(spark, landed_path(spark, sf, "field"), layout="field")
    return landing.explode_readings(docs).select(
        "province_name", "latitude", "longitude", F.unix_timestamp("datetime").alias("dt"), "pm2_5"
    )


def landing_folder(spark: SparkSession, sf: str) -> DataFrame:
    """The same from one folder per station."""
    docs = landing.read_landed(spark, landed_path(spark, sf, "folder"), layout="folder")
    return landing.explode_readings(docs).select(
        "province_name", "latitude", "longitude", F.unix_timestamp("datetime").alias("dt"), "pm2_5"
    )


def landing_file(spark: SparkSession, sf: str) -> DataFrame:
    """The same from one file per station, named after it."""
    docs = landing.read_landed(spark, landed_path(spark, sf, "file"))
    return landing.explode_readings(docs).select(
        "province_name", "latitude", "longitude", F.unix_timestamp("datetime").alias("dt"), "pm2_5"
    )


def landing_days(spark: SparkSession, sf: str) -> DataFrame:
    """One week of readings from documents landed by day; folders of other days are not opened."""
    path = scratch_path(spark, "landed")
    landing.land(landing.reading_documents(flat_readings(spark, sf), by_day=True), path, layout="day")
    return landing.readings_between(spark, path, 1704646800, 1705251600).select(
        "province_name", F.unix_timestamp("datetime").alias("dt"), "pm2_5"
    )


def landing_pretty(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the stations' files are pretty-printed; a second pass over these alone recovers their documents."""
    path = scratch_path(spark, "landed")
    docs = stored(landing.reading_documents(flat_readings(spark, sf)), "documents")
    even = F.regexp_extract("province_name", "[0-9]+$", 0).cast("long") % 2 == 0
    for rows, pretty in ((docs.where(even), True), (docs.where(~even), False)):
        landing.land(rows, path, layout="folder", pretty=pretty, append=True)
    parsed = landing.explode_readings(
        landing.read_landed(spark, path, layout="folder", files=True), keep_empty=True)
    whole = landing.with_broken_files(spark, stored(parsed, "parsed"), path, scratch_path(spark, "recovered"), layout="folder")
    return whole.where("datetime IS NOT NULL").select(
        "province_name", "latitude", "longitude", F.unix_timestamp("datetime").alias("dt"), "pm2_5"
    )


def extraction(spark: SparkSession, sf: str) -> DataFrame:
    """Readings of all listed stations over the whole time, with coordinates from a list, landed and read back."""
    customers = table(spark, sf, "customer")
    listed = customers.select(station_name("c_custkey").alias("province_name"))
    coordinates = customers.select(
        F.col("c_custkey").cast("int").alias("province_id"), station_name("c_custkey").alias("province_name"),
        (F.col("c_custkey") % 15 + 5).cast("decimal(10,4)").alias("latitude"),
        (F.col("c_custkey") % 8 + 97).cast("decimal(10,4)").alias("longitude"),
    )
    path = scratch_path(spark, "extracted")
    readings = flat_readings(spark, sf).select("province_name", "dt", "pm2_5")
    start, end = readings.agg(F.min("dt"), F.max("dt")).first()
    air_quality.extract(readings, listed, coordinates, start, end, path)
    return landing.explode_readings(landing.read_landed(spark, path, layout="field")).select(
        "province_name", "latitude", "longitude", F.unix_timestamp("datetime").alias("dt"), "pm2_5"
    )


def landing_report(spark: SparkSession, sf: str) -> DataFrame:
    docs = landing.read_landed(spark, landed_path(spark, sf, "field"), layout="field")
    expected = table(spark, sf, "customer").select(station_name("c_custkey").alias("province_name"))
    return landing.landing_status(expected, landing.explode_readings(docs, keep_empty=True))


def landing_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Expected, found and missing stations, from the listing of one folder per station."""
    path = landed_path(spark, sf, "folder")
    expected = table(spark, sf, "customer").select(station_name("c_custkey").alias("province_name"))
    return quality.completeness(expected, landing.landed_files(spark, path, layout="folder"), "province_name")


def published_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job: land, check, build, audit, publish, and read what was published."""
    stream = Stream(spark, sf)
    hours = stream.grid()
    # The job reads its bounds in the session zone; the landed epochs are UTC.
    local = F.date_format(F.timestamp_seconds(epoch_seconds(F.col("wall"), "UTC")), "yyyy-MM-dd HH:mm:ss")
    start, end = (
        spark.range(1).select(F.lit(t).alias("wall")).select(local).first()[0] for t in (hours.start, hours.end)
    )
    job = air_quality.Job(landed_path(spark, sf, "field"), scratch_path(spark, "star"), start, end, layout="field")
    air_quality.run(spark, stream.stations().select(station_name("user_id").alias("province_name")), job)
    return air_quality.published(spark, job)["fact_air_quality"]


def nest_explode_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    item = "ARRAY<STRUCT<event_id: BIGINT, event_type: STRING, value: DOUBLE>>"
    fields = [F.col("event_id"), F.col("event_type"), F.col("value")]
    docs = landing.nest(table(spark, sf, "events"), "user_id", "items", fields, ["event_id", "event_type", "value"])
    text = docs.select("user_id", F.to_json("items").alias("doc"))
    return text.select("user_id", F.explode(F.from_json("doc", item)).alias("i")).select("user_id", "i.*")


# --- tables --------------------------------------------------------------------------------------

LINEITEM = {
    "l_orderkey": "BIGINT", "l_partkey": "BIGINT", "l_suppkey": "BIGINT", "l_linenumber": "INT",
    "l_quantity": "DOUBLE", "l_extendedprice": "DOUBLE", "l_discount": "DOUBLE", "l_tax": "DOUBLE",
    "l_returnflag": "STRING", "l_linestatus": "STRING", "l_shipdate": "TIMESTAMP_NTZ",
}

TYPED = {
    "dim_customer": {"customer_id": "INT NOT NULL", "customer_name": "VARCHAR(255) NOT NULL"},
    "fact_orders": {"record_id": "INT NOT NULL", "customer_id": "INT NOT NULL", "price": "DECIMAL(12,2) NOT NULL",
                    "order_date": "DATE NOT NULL"},
}


def parquet_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lineitem")
    tables.write_table(table(spark, sf, "lineitem"), path)
    return tables.read_table(spark, path, LINEITEM)


def typed_table_load(spark: SparkSession, sf: str) -> DataFrame:
    """Recreate two typed tables, load one by position and one by column list with a generated key."""
    location = scratch_path(spark, "tables")
    database = "loaded_" + location.rsplit("-", 1)[1]
    tables.setup_star(spark, database, location, TYPED)
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    tables.load_by_position(customers, f"{database}.dim_customer", TYPED["dim_customer"])
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("order_date"), "o_orderkey",
    )
    keyed = dense_key(orders, ["o_orderkey"], "record_id")
    columns = ["customer_id", "price", "order_date", "record_id"]
    tables.load_columns(keyed.select(*columns), f"{database}.fact_orders", columns, TYPED["fact_orders"])
    return spark.table(f"{database}.fact_orders").join(spark.table(f"{database}.dim_customer"), "customer_id")


def typed_table_reset(spark: SparkSession, sf: str) -> DataFrame:
    """Load a table, set it up again at the same place, and load other rows: the first are gone."""
    location = scratch_path(spark, "reset")
    database = "reset_" + location.rsplit("-", 1)[1]
    for name, columns in (("customer", ("c_custkey", "c_name")), ("supplier", ("s_suppkey", "s_name"))):
        tables.setup_star(spark, database, location, TYPED)
        if not spark.table(f"{database}.dim_customer").isEmpty():
            raise RuntimeError("rows are left after the set-up")
        rows = table(spark, sf, name).select(*columns)
        tables.load_by_position(rows, f"{database}.dim_customer", TYPED["dim_customer"])
    return spark.table(f"{database}.dim_customer")


def csv_reference_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "names")
    rows = table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("ADM1_EN"), "c_mktsegment")
    rows.write.option("header", True).csv(path)
    return lists.entity_list(spark, path)


def coordinates_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "coordinates")
    rows = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("province_id"), F.col("c_name").alias("province_name"),
        (F.col("c_custkey") % 15 + 5).cast("decimal(10,4)").alias("latitude"),
        (F.col("c_custkey") % 8 + 97).cast("decimal(10,4)").alias("longitude"),
    )
    rows.write.option("header", True).csv(path)
    return lists.coordinates(spark, path)


# --- quality -------------------------------------------------------------------------------------

DQ_RULES = {
    "nation": [
        quality.SchemaRule((("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int"))),
        quality.Rule("row_count", None, "=", 25),
        quality.Rule("missing_count", "n_name"),
        quality.Rule("duplicate_count", "n_nationkey"),
        quality.Rule("duplicate_count", "n_regionkey"),
        quality.Rule("min", "n_nationkey", "=", 0),
        quality.Rule("max", "n_nationkey", "=", 24),
        quality.Rule("min_length", "n_name", "=", 8),
        quality.Rule("max_length", "n_name", "<=", 9),
    ],
    "orders": [
        quality.SchemaRule((("o_orderkey", "int"), ("o_missing", "string"))),
        quality.Rule("missing_count", "o_orderkey"),
        quality.Rule("duplicate_count", "o_orderkey"),
        quality.Rule("invalid_count", "o_orderstatus", valid=("F", "O")),
        quality.Rule("min_length", "o_orderpriority", ">=", 5),
        quality.Rule("max_length", "o_orderpriority", "=", 15),
        quality.Rule("row_count", None, ">=", 1),
    ],
    "events": [
        quality.Rule("missing_count", "value"),
        quality.Rule("duplicate_count", "event_id"),
        quality.Rule("min", "event_id", ">=", 0),
        quality.Rule("invalid_count", "event_type", valid=("click", "view", "purchase", "signup", "error")),
        quality.Rule("missing_count", "no_such_column"),
    ],
    "lineitem": [
        quality.Rule("duplicate_count", "l_orderkey"),
        quality.Rule("min", "l_linenumber", "=", 1),
        quality.Rule("max", "l_linenumber", "<=", 7),
        quality.Rule("missing_count", "l_shipdate"),
    ],
}


def surrogate_key_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Orders loaded in two parts by date; the second part's keys go on where the first part's end."""
    orders, folder = table(spark, sf, "orders"), scratch_path(spark, "loads")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    early = F.col("o_orderdate").cast("timestamp_ntz") < cut
    for name, rows in (("early", early), ("late", ~early)):
        part = orders.where(rows).select("o_orderkey", "o_custkey", "o_totalprice")
        appends.append_numbered(folder, name, part, ["o_orderkey"], "order_id", "bigint")
    return appends.appended(spark, folder)


def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.scan({name: table(spark, sf, name) for name in DQ_RULES}, DQ_RULES)


def dq_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The same rules, with the simple metrics taken while copies of the tables are written."""
    copies, measured = {}, {}
    for name, rules in DQ_RULES.items():
        measured[name], path = quality.Measured(rules), scratch_path(spark, f"copy-{name}")
        tables.write_table(table(spark, sf, name), path, observe=measured[name].observe)
        copies[name] = spark.read.parquet(path)
    return quality.scan(copies, DQ_RULES, measured)


def dq_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """Per table: how many rules there are, how many failed, and whether the table passes."""
    return dq_report(spark, sf).groupBy("table").agg(
        F.count("*").alias("rules"), F.count_if(~F.col("passed")).alias("failed"),
        F.bool_and("passed").alias("passed"),
    )


FOREIGN_KEYS = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("documents", "doc_id", "labels", "doc_id"),
)


def fk_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        quality.foreign_key_verdict(child, table(spark, sf, child), fk, table(spark, sf, parent), pk)
        for child, fk, parent, pk in FOREIGN_KEYS
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fk_unlike_types(spark: SparkSession, sf: str) -> DataFrame:
    """Keys stored as doubles, decimals and text against integer keys; the part numbers are halved, so that some have no parent."""
    child = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("double").alias("order_key"), F.col("l_suppkey").cast("decimal(14,3)").alias("supplier_key"),
        (F.col("l_partkey") / 2).cast("decimal(14,1)").alias("part_key"),
    )
    keys = {"order_key": ("orders", "o_orderkey"), "supplier_key": ("supplier", "s_suppkey"), "part_key": ("part", "p_partkey")}
    return quality.foreign_key_verdicts("lineitem", child, {c: (table(spark, sf, t), k) for c, (t, k) in keys.items()})


def interval_join(spark: SparkSession, sf: str) -> DataFrame:
    """Line prices with all orders whose total price lies at most ten below them."""
    price = F.col("o_totalprice").cast("decimal(12,2)")
    bands = table(spark, sf, "orders").select("o_orderkey", price.alias("low"), (price + 10).cast("decimal(12,2)").alias("high"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    return intervals.interval_join(lines, "price", bands, "low", "high")


def region_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Balances per region; customers are summed per nation before any join."""
    per_nation = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.sum(F.col("c_acctbal").cast("decimal(12,2)")).alias("total"), F.count("*").alias("n")
    )
    regions = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    joined = per_nation.join(table(spark, sf, "nation"), "n_nationkey").join(regions, "n_regionkey")
    return joined.groupBy(F.col("r_name").alias("region")).agg(
        F.sum("n").alias("customers"),
        mean_of(F.sum("total"), F.sum("n"), 2, "decimal(12,2)").alias("avg_balance"),
    )


def union_by_name(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    seed = empty_table(spark, {"name": "STRING", "balance": "DOUBLE"})
    return seed.unionByName(customers).unionByName(suppliers)


QUERIES: dict[str, Query] = {
    "hourly_aqi": stream(Stream.hourly_aqi),
    "json_props_parse": lambda spark, sf: table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k INT")["k"].alias("k")),
    "nest_explode_roundtrip": nest_explode_roundtrip,
    "landing_roundtrip": landing_roundtrip,
    "landing_folder": landing_folder,
    "landing_file": landing_file,
    "landing_days": landing_days,
    "landing_pretty": landing_pretty,
    "extraction": extraction,
    "landing_report": landing_report,
    "landing_counts": landing_counts,
    "drop_negative": lambda spark, sf: series.drop_negative(
        table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal"),
    "round_one_decimal": lambda spark, sf: table(spark, sf, "events").select(
        "event_id", round_reading(F.col("value")).alias("reading")),
    "time_range_filter": lambda spark, sf: landing.between_walls(
        table(spark, sf, "events").select("event_id", "ts"), "ts", "2024-01-08 00:00:00", "2024-01-15 00:00:00", ZONE),
    "epoch_range_filter": lambda spark, sf: landing.between_epochs(
        flat_readings(spark, sf).select("province_name", "dt", "pm2_5"), "dt",
        epoch_seconds(F.lit("2024-01-08 00:00:00"), ZONE), epoch_seconds(F.lit("2024-01-15 00:00:00"), ZONE)),
    "unix_time": lambda spark, sf: table(spark, sf, "orders").select(
        "o_orderkey", epoch_seconds(F.col("o_orderdate"), ZONE).alias("epoch")),
    "split_list": lambda spark, sf: table(spark, sf, "documents").select("doc_id", split_list(F.col("text")).alias("item")),
    "hourly_spine": stream(Stream.spine),
    "align_left": stream(Stream.aligned),
    "entity_mean": stream(Stream.means),
    "entity_mode": lambda spark, sf: series.entity_mode(table(spark, sf, "events"), "user_id", "event_type", "mode"),
    "impute_mean": stream(Stream.imputed),
    "rolling_24": stream(Stream.rolled),
    "dedup_keep_one": stream(Stream.unique),
    "complete_series": stream(Stream.complete),
    "incremental_series": stream(Stream.by_batches),
    "aqi_band_join": lambda spark, sf: aqi.join_bands(concentrations(spark, sf), "concentration"),
    "aqi_value": lambda spark, sf: aqi.with_aqi(concentrations(spark, sf), "concentration"),
    "aqi_severity_counts": lambda spark, sf: concentrations(spark, sf).groupBy(
        aqi.severity(F.col("concentration")).alias("severity")).agg(F.count("*").alias("n")),
    "dim_entity": lambda spark, sf: star.dim_entity(
        table(spark, sf, "customer"), "c_name", "entity_id", ["c_nationkey", "c_mktsegment"]),
    "dim_date": lambda spark, sf: star.dim_date(table(spark, sf, "orders"), "o_orderdate"),
    "dim_time": lambda spark, sf: star.dim_time(table(spark, sf, "events"), "ts"),
    "fact_build": report(lambda s: s.fact),
    "surrogate_key": lambda spark, sf: dense_key(
        table(spark, sf, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "order_id"),
    "star_join": star_join,
    "star_join_period": star_join_period,
    "report_monthly_profile": report(lambda s: reports.monthly_profile(s.fact, s.dates)),
    "report_monthly_trend": report(lambda s: reports.monthly_trend(s.fact, s.dates)),
    "report_weekday_weekend": report(lambda s: reports.weekday_weekend(s.fact, s.dates)),
    "report_top_entities": report(lambda s: reports.top_entities(s.fact, s.stations, "station_id", "station", 10)),
    "report_severity": report(lambda s: reports.severity_distribution(s.fact)),
    "report_region": report_region,
    "report_region_partial": report_region_partial,
    "report_hour_profile": report(lambda s: reports.hour_profile(s.fact, s.times)),
    "region_rollup": region_rollup,
    "coord_enrich": lambda spark, sf: enrich(
        table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation")),
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", "s_name", "s_acctbal"),
        "nation", "s_suppkey", ["s_name", "s_acctbal"]),
    "missing_keys": lambda spark, sf: quality.missing_keys(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id"),
    "completeness_counts": lambda spark, sf: quality.completeness(
        table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id"),
    "fk_orphans": lambda spark, sf: quality.fk_orphans(
        table(spark, sf, "documents"), "doc_id", table(spark, sf, "labels"), "doc_id"),
    "fk_verdicts": fk_verdicts,
    "fk_unlike_types": fk_unlike_types,
    "interval_join": interval_join,
    "surrogate_key_loads": surrogate_key_loads,
    "dq_report": dq_report,
    "dq_observed": dq_observed,
    "dq_verdict": dq_verdict,
    "union_by_name": union_by_name,
    "csv_reference_scan": csv_reference_scan,
    "coordinates_scan": coordinates_scan,
    "parquet_roundtrip": parquet_roundtrip,
    "typed_table_load": typed_table_load,
    "typed_table_reset": typed_table_reset,
    "published_fact": published_fact,
}
