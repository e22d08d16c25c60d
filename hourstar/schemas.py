"""Explicit schemas. Nothing in the package infers one.

Fixed values: column names, types and keys of the raw documents and of the star are given.
"""

# One document per province: coordinates and the hourly readings. Other fields are not read.
RAW = (
    "coord STRUCT<lon: DECIMAL(10,4), lat: DECIMAL(10,4)>, "
    "list ARRAY<STRUCT<components: STRUCT<pm2_5: DECIMAL(10,2)>, dt: BIGINT>>"
)

# Readings taken out of the documents, two decimals as read.
READINGS = (
    "latitude DECIMAL(10,4), longitude DECIMAL(10,4), province_name STRING, datetime TIMESTAMP, "
    "pm2_5 DECIMAL(10,2), corrupt BOOLEAN"
)

BREAKPOINTS = {"c_low": "DOUBLE", "c_high": "DOUBLE", "i_low": "INT", "i_high": "INT"}

COORDINATES = "province_id INT, province_name STRING, latitude DECIMAL(10,4), longitude DECIMAL(10,4)"

# Star tables in load order (dimensions first), as column -> SQL type.
STAR = {
    "dim_province": {
        "province_id": "INT NOT NULL",
        "province_name": "VARCHAR(255) NOT NULL",
        "latitude": "DECIMAL(10,4) NOT NULL",
        "longitude": "DECIMAL(10,4) NOT NULL",
    },
    "dim_date": {
        "date_key": "VARCHAR(8) NOT NULL",
        "date": "DATE NOT NULL",
        "year": "INT NOT NULL",
        "quarter": "INT NOT NULL",
        "month": "INT NOT NULL",
        "day": "INT NOT NULL",
        "day_of_week": "VARCHAR(3) NOT NULL",
        "start_of_year": "DATE NOT NULL",
        "start_of_quarter": "DATE NOT NULL",
        "start_of_month": "DATE NOT NULL",
    },
    "dim_time": {
        "time_key": "VARCHAR(2) NOT NULL",
        "hour": "INT NOT NULL",
    },
    "fact_air_quality": {
        "record_id": "INT NOT NULL",
        "record_date": "VARCHAR(8) NOT NULL",
        "record_time": "VARCHAR(2) NOT NULL",
        "province_id": "INT NOT NULL",
        "pm2_5": "DECIMAL(10,1) NOT NULL",
        "aqi": "INT NOT NULL",
    },
}

PRIMARY_KEYS = {
    "dim_province": "province_id",
    "dim_date": "date_key",
    "dim_time": "time_key",
    "fact_air_quality": "record_id",
}

# Fact column -> (dimension, dimension key).
FOREIGN_KEYS = {
    "record_date": ("dim_date", "date_key"),
    "record_time": ("dim_time", "time_key"),
    "province_id": ("dim_province", "province_id"),
}


def columns_ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {sql_type}" for name, sql_type in columns.items())


def simple_type(sql_type: str) -> str:
    """The type of a declared column as Spark reads it: VARCHAR is a string, NOT NULL is dropped."""
    name = sql_type.removesuffix(" NOT NULL")
    return "STRING" if name.startswith("VARCHAR") else name


def read_ddl(columns: dict[str, str]) -> str:
    return columns_ddl({name: simple_type(t) for name, t in columns.items()})
