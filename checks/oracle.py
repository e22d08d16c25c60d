"""SQL on the plain tables for every query in ``checks.queries``."""

from __future__ import annotations

from checks.queries import FOREIGN_KEYS
from hourstar.functions.aqi import PM25_BANDS

READINGS = """
readings AS (
  SELECT user_id, date_trunc('hour', ts) AS datetime, event_id,
         CAST(round(CAST(value AS DECIMAL(10,2)), 1) AS DECIMAL(10,1)) AS value
  FROM events WHERE CAST(value AS DECIMAL(10,2)) >= 0
)"""

SPINE = """
spine AS (
  SELECT user_id, datetime
  FROM (SELECT DISTINCT user_id FROM events)
  CROSS JOIN (
    SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), INTERVAL 1 HOUR)) AS datetime
    FROM events)
)"""


def tenths(column: str) -> str:
    return f"CAST({column} * 10 AS BIGINT)"


def mean_one_decimal(total_tenths: str, n: str) -> str:
    """Exact mean to five decimals, then to one, both half up; for values of zero and more."""
    five = f"((2 * {total_tenths} * 10000 + {n}) // (2 * {n}))"
    return f"CAST(CAST(({five} + 5000) // 10000 AS DECIMAL(12,0)) * 0.1 AS DECIMAL(10,1))"


def mean_two_decimals(total: str, per_unit: int, n: str) -> str:
    """Exact mean to two decimals, half up, of a total in units of 1/``per_unit``."""
    scaled = 100 // per_unit
    return f"CAST(CAST((2 * ({total}) * {scaled} + {n}) // (2 * {n}) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(12,2))"


MEANS = f"""
means AS (
  SELECT user_id, {mean_one_decimal(f"sum({tenths('value')})", "count(*)")} AS value_mean
  FROM readings GROUP BY user_id
)"""


def kept(order: str) -> str:
    return f"""
kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, datetime ORDER BY {order}) AS rn FROM readings)
  WHERE rn = 1
)"""


def filled(source: str) -> str:
    return f"""
filled AS (
  SELECT s.user_id, s.datetime, coalesce(r.value, m.value_mean) AS value
  FROM spine s LEFT JOIN {source} r USING (user_id, datetime) LEFT JOIN means m USING (user_id)
)"""


ROLLED = f"""
rolled AS (
  SELECT user_id, datetime, value,
         {mean_one_decimal(f"(sum({tenths('value')}) OVER w)", "(count(value) OVER w)")} AS value_24h
  FROM filled
  WINDOW w AS (PARTITION BY user_id ORDER BY datetime ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)
)"""


def case(value: str, low: str, high: str, result, overflow: str) -> str:
    whens = " ".join(
        f"WHEN {value} BETWEEN {getattr(b, low)} AND {getattr(b, high)} THEN {result(b)}" for b in PM25_BANDS
    )
    return f"CASE {whens} WHEN {value} > {getattr(PM25_BANDS[-1], high)} THEN {overflow} END"


def aqi(value: str) -> str:
    def line(b) -> str:
        low, high = f"CAST({b.c_low} AS DOUBLE)", f"CAST({b.c_high} AS DOUBLE)"
        slope = f"(CAST({b.i_high - b.i_low} AS DOUBLE) / ({high} - {low}))"
        return f"CAST(round({slope} * (CAST({value} AS DOUBLE) - {low}) + {b.i_low}) AS INTEGER)"

    return case(value, "c_low", "c_high", line, "500")


def severity(value: str) -> str:
    return case(value, "c_low", "c_high", lambda b: f"'{b.label}'", "'Hazardous'")


def severity_of_index(value: str) -> str:
    return case(value, "i_low", "i_high", lambda b: f"'{b.label}'", "'Hazardous'")


def series(order: str = "event_id") -> str:
    return ",".join([READINGS, SPINE, MEANS, kept(order), filled("kept"), ROLLED])


CONCENTRATIONS = """
concentrations AS (
  SELECT event_id, CAST(round(CAST(value * 2 AS DECIMAL(10,2)), 1) AS DECIMAL(10,1)) AS concentration FROM events
)"""

CALENDAR = """strftime(d, '%Y%m%d') AS date_key, CAST(d AS DATE) AS date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, strftime(d, '%a') AS day_of_week,
  CAST(date_trunc('year', d) AS DATE) AS start_of_year, CAST(date_trunc('quarter', d) AS DATE) AS start_of_quarter,
  CAST(date_trunc('month', d) AS DATE) AS start_of_month"""

STAR = f"""
aqi_rows AS (
  SELECT CAST(user_id AS VARCHAR) AS station, datetime, value AS pm2_5, {aqi('value_24h')} AS aqi FROM rolled
),
stations AS (
  SELECT station, CAST(row_number() OVER (ORDER BY station) AS INTEGER) AS station_id
  FROM (SELECT DISTINCT station FROM aqi_rows WHERE aqi IS NOT NULL)
),
fact AS (
  SELECT strftime(datetime, '%Y%m%d') AS record_date, strftime(datetime, '%H') AS record_time, station_id, pm2_5, aqi
  FROM aqi_rows JOIN stations USING (station) WHERE aqi IS NOT NULL
),
dates AS (
  SELECT {CALENDAR} FROM (SELECT DISTINCT date_trunc('day', datetime) AS d FROM aqi_rows WHERE aqi IS NOT NULL)
)"""

STAR_WITH = f"WITH {series()},{STAR}"

REPORT = f"""{mean_two_decimals(f"sum({tenths('pm2_5')})", 10, "count(*)")} AS avg_pm2_5,
  {mean_two_decimals("sum(aqi)", 1, "count(*)")} AS avg_aqi,
  max(aqi) AS max_aqi, count(*) AS hours"""

FACT_DATES = "fact JOIN dates ON record_date = date_key"

FLAT = """
flat AS (
  SELECT 'Station ' || user_id AS province_name,
         CAST(5 + user_id % 15 AS DECIMAL(10,4)) AS latitude, CAST(97 + user_id % 8 AS DECIMAL(10,4)) AS longitude,
         CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS dt, CAST(value AS DECIMAL(10,2)) AS pm2_5
  FROM events
)"""

# Unix times of the Bangkok wall times 2024-01-08 00:00 and 2024-01-15 00:00.
FROM_EPOCH, TO_EPOCH = 1704646800, 1705251600


def verdict(table: str, check: str, column: str | None, compare: str, bound: int, actual: str) -> str:
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", {name} AS \"column\", '{compare} {bound}' AS expected, "
        f"CAST(v AS VARCHAR) AS actual, v {compare} {bound} AS passed FROM ({actual})"
    )


def fixed(table: str, check: str, column: str | None, expected: str, actual: str, passed: bool) -> str:
    name = f"'{column}'" if column else "CAST(NULL AS VARCHAR)"
    return f"SELECT '{table}', '{check}', {name}, '{expected}', '{actual}', {str(passed).upper()}"


def _agg(table: str, expression: str) -> str:
    return f"SELECT {expression} AS v FROM {table}"


def _dups(table: str, column: str) -> str:
    return f"SELECT count(*) AS v FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"


def _missing(table: str, column: str) -> str:
    return _agg(table, f"count(*) FILTER ({column} IS NULL)")


DQ = " UNION ALL ".join([
    verdict("nation", "row_count", None, "=", 25, _agg("nation", "count(*)")),
    verdict("nation", "missing_count", "n_name", "=", 0, _missing("nation", "n_name")),
    verdict("nation", "duplicate_count", "n_nationkey", "=", 0, _dups("nation", "n_nationkey")),
    verdict("nation", "duplicate_count", "n_regionkey", "=", 0, _dups("nation", "n_regionkey")),
    verdict("nation", "min", "n_nationkey", "=", 0, _agg("nation", "min(n_nationkey)")),
    verdict("nation", "max", "n_nationkey", "=", 24, _agg("nation", "max(n_nationkey)")),
    verdict("nation", "min_length", "n_name", "=", 8, _agg("nation", "min(length(n_name))")),
    verdict("nation", "max_length", "n_name", "<=", 9, _agg("nation", "max(length(n_name))")),
    fixed("nation", "required_columns", None, "n_nationkey, n_name, n_regionkey", "all", True),
    fixed("nation", "column_types", None, "n_nationkey: int, n_name: string, n_regionkey: int", "all", True),
    fixed("orders", "required_columns", None, "o_orderkey, o_missing", "missing: o_missing", False),
    fixed("orders", "column_types", None, "o_orderkey: int, o_missing: string", "o_orderkey: bigint", False),
    verdict("orders", "missing_count", "o_orderkey", "=", 0, _missing("orders", "o_orderkey")),
    verdict("orders", "duplicate_count", "o_orderkey", "=", 0, _dups("orders", "o_orderkey")),
    verdict("orders", "invalid_count", "o_orderstatus", "=", 0,
            _agg("orders", "count(*) FILTER (o_orderstatus NOT IN ('F', 'O'))")),
    verdict("orders", "min_length", "o_orderpriority", ">=", 5, _agg("orders", "min(length(o_orderpriority))")),
    verdict("orders", "max_length", "o_orderpriority", "=", 15, _agg("orders", "max(length(o_orderpriority))")),
    verdict("orders", "row_count", None, ">=", 1, _agg("orders", "count(*)")),
    verdict("events", "missing_count", "value", "=", 0, _missing("events", "value")),
    verdict("events", "duplicate_count", "event_id", "=", 0, _dups("events", "event_id")),
    verdict("events", "min", "event_id", ">=", 0, _agg("events", "min(event_id)")),
    verdict("events", "invalid_count", "event_type", "=", 0,
            _agg("events", "count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase', 'signup', 'error'))")),
    fixed("events", "missing_count", "no_such_column", "= 0", "no such column", False),
    verdict("lineitem", "duplicate_count", "l_orderkey", "=", 0, _dups("lineitem", "l_orderkey")),
    verdict("lineitem", "min", "l_linenumber", "=", 1, _agg("lineitem", "min(l_linenumber)")),
    verdict("lineitem", "max", "l_linenumber", "<=", 7, _agg("lineitem", "max(l_linenumber)")),
    verdict("lineitem", "missing_count", "l_shipdate", "=", 0, _missing("lineitem", "l_shipdate")),
])

FK = " UNION ALL ".join(
    verdict(child, "orphan_count", fk, "=", 0,
            f"SELECT count(*) AS v FROM {child} c WHERE {fk} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})")
    for child, fk, parent, pk in FOREIGN_KEYS
)

ORACLE: dict[str, str] = {
    "hourly_aqi": f"WITH {series()} SELECT *, {aqi('value_24h')} AS aqi FROM rolled WHERE value_24h IS NOT NULL",
    "json_props_parse": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
    "nest_explode_roundtrip": "SELECT user_id, event_id, event_type, value FROM events",
    "landing_roundtrip": f"WITH {FLAT} SELECT * FROM flat",
    "landing_report": f"""WITH {FLAT}
      SELECT 'Station ' || c_custkey AS province_name, count(f.dt) AS readings, CAST(0 AS BIGINT) AS corrupt,
             CASE WHEN count(f.dt) = 0 THEN 'missing' ELSE 'ok' END AS status
      FROM customer LEFT JOIN flat f ON f.province_name = 'Station ' || c_custkey GROUP BY 1""",
    "landing_folder": f"WITH {FLAT} SELECT * FROM flat",
    "landing_file": f"WITH {FLAT} SELECT * FROM flat",
    "landing_days": f"""WITH {FLAT} SELECT province_name, dt, pm2_5 FROM flat
      WHERE dt BETWEEN {FROM_EPOCH} AND {TO_EPOCH}""",
    "landing_pretty": f"WITH {FLAT} SELECT * FROM flat",
    "extraction": f"""WITH {FLAT}
      SELECT province_name, CAST(c_custkey % 15 + 5 AS DECIMAL(10,4)) AS latitude,
             CAST(c_custkey % 8 + 97 AS DECIMAL(10,4)) AS longitude, dt, pm2_5
      FROM (SELECT province_name, dt, pm2_5 FROM flat) JOIN customer ON province_name = 'Station ' || c_custkey""",
    "landing_counts": """SELECT count(*) AS expected, count(u.user_id) AS found, count(*) - count(u.user_id) AS missing
      FROM customer LEFT JOIN (SELECT DISTINCT user_id FROM events) u ON user_id = c_custkey""",
    "drop_negative": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0",
    "round_one_decimal":
        "SELECT event_id, CAST(round(CAST(value AS DECIMAL(10,2)), 1) AS DECIMAL(10,1)) AS reading FROM events",
    "time_range_filter": """SELECT event_id, ts FROM events
      WHERE ts BETWEEN TIMESTAMP '2024-01-07 17:00:00' AND TIMESTAMP '2024-01-14 17:00:00'""",
    "epoch_range_filter": f"""WITH {FLAT} SELECT province_name, dt, pm2_5 FROM flat
      WHERE dt BETWEEN {FROM_EPOCH} AND {TO_EPOCH}""",
    "unix_time": "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) - 7 * 3600 AS epoch FROM orders",
    "split_list": "SELECT doc_id, unnest(string_split(text, ',')) AS item FROM documents",
    "hourly_spine": f"WITH {SPINE} SELECT * FROM spine",
    "align_left": f"WITH {READINGS},{SPINE} SELECT user_id, datetime, event_id, value FROM spine LEFT JOIN readings USING (user_id, datetime)",
    "entity_mean": f"WITH {READINGS},{MEANS} SELECT * FROM means",
    "entity_mode": """SELECT user_id, event_type AS mode FROM (
      SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
      FROM events GROUP BY user_id, event_type) WHERE rn = 1""",
    "impute_mean": f"WITH {READINGS},{SPINE},{MEANS},{filled('readings')} SELECT * FROM filled",
    "rolling_24": f"WITH {series()} SELECT * FROM rolled",
    "dedup_keep_one": f"WITH {READINGS},{kept('event_id')} SELECT * FROM kept",
    "complete_series": f"WITH {series()} SELECT * FROM rolled",
    "incremental_series": f"WITH {series()} SELECT * FROM rolled",
    "aqi_band_join": f"""WITH {CONCENTRATIONS}, bands(c_low, c_high, i_low, i_high, label) AS (VALUES {', '.join(
        f"(CAST({b.c_low} AS DOUBLE), CAST({b.c_high} AS DOUBLE), CAST({b.i_low} AS INTEGER), CAST({b.i_high} AS INTEGER), '{b.label}')"
        for b in PM25_BANDS)})
      SELECT * FROM concentrations JOIN bands
      ON CAST(least(concentration, 500.4) AS DOUBLE) BETWEEN c_low AND c_high""",
    "aqi_value": f"""WITH {CONCENTRATIONS} SELECT * FROM (
      SELECT event_id, concentration, {aqi('concentration')} AS aqi FROM concentrations) WHERE aqi IS NOT NULL""",
    "aqi_severity_counts":
        f"WITH {CONCENTRATIONS} SELECT {severity('concentration')} AS severity, count(*) AS n FROM concentrations GROUP BY 1",
    "dim_entity": """SELECT CAST(row_number() OVER (ORDER BY c_name) AS INTEGER) AS entity_id, c_name, c_nationkey, c_mktsegment
      FROM customer""",
    "dim_date": f"SELECT {CALENDAR} FROM (SELECT DISTINCT date_trunc('day', o_orderdate) AS d FROM orders)",
    "dim_time": "SELECT DISTINCT strftime(ts, '%H') AS time_key, CAST(hour(ts) AS INTEGER) AS hour FROM events",
    "fact_build": f"{STAR_WITH} SELECT * FROM fact",
    "surrogate_key": """SELECT CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS order_id,
      o_orderdate, o_orderkey FROM orders""",
    "star_join": f"""{STAR_WITH} SELECT f.*, d.* EXCLUDE (date_key), CAST(f.record_time AS INTEGER) AS hour, s.station
      FROM fact f JOIN dates d ON record_date = date_key JOIN stations s USING (station_id)""",
    "star_join_period": f"""{STAR_WITH} SELECT f.*, d.* EXCLUDE (date_key), CAST(f.record_time AS INTEGER) AS hour, s.station
      FROM fact f JOIN dates d ON record_date = date_key JOIN stations s USING (station_id) WHERE day_of_week IN ('Sat', 'Sun')""",
    "report_monthly_profile": f"{STAR_WITH} SELECT month, {REPORT} FROM {FACT_DATES} GROUP BY month",
    "report_monthly_trend": f"{STAR_WITH} SELECT start_of_month, {REPORT} FROM {FACT_DATES} GROUP BY start_of_month",
    "report_weekday_weekend": f"""{STAR_WITH} SELECT CASE WHEN day_of_week IN ('Sat', 'Sun') THEN 'weekend' ELSE 'weekday' END AS day_kind,
      {REPORT} FROM {FACT_DATES} GROUP BY 1""",
    "report_top_entities": f"""{STAR_WITH} SELECT station, {REPORT} FROM fact JOIN stations USING (station_id)
      GROUP BY station ORDER BY avg_aqi DESC, max_aqi DESC, station LIMIT 10""",
    "report_severity": f"{STAR_WITH} SELECT {severity_of_index('aqi')} AS severity, count(*) AS hours FROM fact GROUP BY 1",
    "report_region": f"""{STAR_WITH} SELECT r_name AS region, {REPORT} FROM fact JOIN stations USING (station_id)
      JOIN customer ON station = CAST(c_custkey AS VARCHAR) JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey GROUP BY 1""",
    "report_region_partial": f"""{STAR_WITH} SELECT coalesce(r_name, 'unknown') AS region, {REPORT} FROM fact JOIN stations USING (station_id)
      LEFT JOIN (SELECT c_custkey, CASE WHEN c_nationkey % 4 = 1 THEN least(r_name, 'ASIA') ELSE r_name END AS r_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE c_nationkey % 3 <> 0) ON station = CAST(c_custkey AS VARCHAR) GROUP BY 1""",
    "report_hour_profile": f"{STAR_WITH} SELECT CAST(record_time AS INTEGER) AS hour, {REPORT} FROM fact GROUP BY 1",
    "region_rollup": f"""WITH c AS (
        SELECT r_name AS region, CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 100 AS BIGINT) AS cents
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
      SELECT region, count(*) AS customers, {mean_two_decimals("sum(cents)", 100, "count(*)")} AS avg_balance
      FROM c GROUP BY region""",
    "coord_enrich": """SELECT c_custkey, c_nationkey AS nation, s_name, s_acctbal FROM customer LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn FROM supplier) s
      ON s_nationkey = c_nationkey AND rn = 1""",
    "missing_keys": "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "completeness_counts": """SELECT count(*) AS expected, count(l.doc_id) AS found, count(*) - count(l.doc_id) AS missing
      FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)""",
    "fk_orphans": """SELECT doc_id, count(*) AS n_rows FROM documents
      WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
    "fk_verdicts": FK,
    "fk_unlike_types": """WITH orphans AS (
        SELECT 'order_key' AS "column", count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT 'supplier_key', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
        UNION ALL SELECT 'part_key', count(*) FROM lineitem WHERE l_partkey % 2 = 1 OR l_partkey // 2 NOT IN (SELECT p_partkey FROM part))
      SELECT 'lineitem' AS "table", 'orphan_count' AS "check", "column", '= 0' AS expected, CAST(n AS VARCHAR) AS actual, n = 0 AS passed
      FROM orphans""",
    "interval_join": """SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, o_orderkey,
        CAST(o_totalprice AS DECIMAL(12,2)) AS low, CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 10 AS DECIMAL(12,2)) AS high
      FROM lineitem JOIN orders ON CAST(l_extendedprice AS DECIMAL(12,2))
        BETWEEN CAST(o_totalprice AS DECIMAL(12,2)) AND CAST(o_totalprice AS DECIMAL(12,2)) + 10""",
    "surrogate_key_loads": """SELECT o_orderkey, o_custkey, o_totalprice,
        row_number() OVER (ORDER BY CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 0 ELSE 1 END, o_orderkey) AS order_id
      FROM orders""",
    "dq_report": DQ,
    "dq_observed": DQ,
    "dq_verdict": f"""SELECT "table", count(*) AS rules, count(*) FILTER (NOT passed) AS failed, bool_and(passed) AS passed
      FROM ({DQ}) GROUP BY 1""",
    "union_by_name": """SELECT c_name AS name, c_acctbal AS balance FROM customer
      UNION ALL SELECT s_name, s_acctbal FROM supplier""",
    "csv_reference_scan": "SELECT c_name AS province_name FROM customer",
    "coordinates_scan": """SELECT CAST(c_custkey AS INTEGER) AS province_id, c_name AS province_name,
      CAST(c_custkey % 15 + 5 AS DECIMAL(10,4)) AS latitude, CAST(c_custkey % 8 + 97 AS DECIMAL(10,4)) AS longitude
      FROM customer""",
    "parquet_roundtrip": "SELECT * FROM lineitem",
    "typed_table_reset": "SELECT CAST(s_suppkey AS INTEGER) AS customer_id, s_name AS customer_name FROM supplier",
    "typed_table_load": """SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS INTEGER) AS record_id,
      CAST(o_custkey AS INTEGER) AS customer_id, CAST(o_totalprice AS DECIMAL(12,2)) AS price,
      CAST(o_orderdate AS DATE) AS order_date, c_name AS customer_name
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "published_fact": f"""WITH {series('value')},
      aqi_rows AS (
        SELECT 'Station ' || user_id AS station, datetime, value AS pm2_5, {aqi('value_24h')} AS aqi FROM rolled),
      stations AS (
        SELECT station, CAST(row_number() OVER (ORDER BY station) AS INTEGER) AS province_id
        FROM (SELECT DISTINCT station FROM aqi_rows WHERE aqi IS NOT NULL)),
      fact AS (
        SELECT strftime(datetime, '%Y%m%d') AS record_date, strftime(datetime, '%H') AS record_time, province_id, pm2_5, aqi
        FROM aqi_rows JOIN stations USING (station) WHERE aqi IS NOT NULL)
      SELECT CAST(row_number() OVER (ORDER BY record_date, record_time, province_id) AS INTEGER) AS record_id, * FROM fact""",
}
