"""Report queries on the star schema.

Each report sums the fact per foreign key first and joins dimensions to those few sums, so the fact
is never shuffled or joined row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourstar.functions.aqi import severity_of_index
from hourstar.functions.values import mean_of
from hourstar.operators.keys import lookup_join


def _sums(fact: DataFrame, fk: str) -> DataFrame:
    return fact.groupBy(fk).agg(
        F.sum("pm2_5").alias("_pm"), F.sum("aqi").alias("_aqi"), F.max("aqi").alias("_max"),
        F.count("*").alias("_n"),
    )


def _means() -> list[Column]:
    n = F.sum("_n")
    return [
        mean_of(F.sum("_pm"), n, 2, "decimal(12,2)").alias("avg_pm2_5"),
        mean_of(F.sum("_aqi").cast("decimal(20,0)"), n, 2, "decimal(12,2)").alias("avg_aqi"),
        F.max("_max").alias("max_aqi"),
        n.alias("hours"),
    ]


def _by_date(fact: DataFrame, dim_date: DataFrame, group: Column) -> DataFrame:
    daily = _sums(fact, "record_date").withColumnRenamed("record_date", "date_key")
    return daily.join(dim_date, "date_key").groupBy(group).agg(*_means())


def monthly_profile(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Means by month of year, most polluted first."""
    return _by_date(fact, dim_date, F.col("month")).orderBy(F.desc("avg_pm2_5"), "month")


def monthly_trend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Means by calendar month, in time order."""
    return _by_date(fact, dim_date, F.col("start_of_month")).orderBy("start_of_month")


def weekday_weekend(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Means on weekdays and at weekends."""
    kind = F.when(F.col("day_of_week").isin("Sat", "Sun"), "weekend").otherwise("weekday")
    return _by_date(fact, dim_date, kind.alias("day_kind"))


def hour_profile(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Means by hour of day."""
    hourly = _sums(fact, "record_time").withColumnRenamed("record_time", "time_key")
    return hourly.join(dim_time, "time_key").groupBy("hour").agg(*_means()).orderBy("hour")


def top_entities(fact: DataFrame, dim: DataFrame, key: str, entity: str, k: int) -> DataFrame:
    """The ``k`` entities with the highest mean index; ties in name order."""
    ranked = _sums(fact, key).join(dim, key).groupBy(entity).agg(*_means())
    return ranked.orderBy(F.desc("avg_aqi"), F.desc("max_aqi"), entity).limit(k)


def severity_distribution(fact: DataFrame) -> DataFrame:
    """Hours per severity label."""
    by_index = fact.groupBy("aqi").agg(F.count("*").alias("_n"))
    return by_index.groupBy(severity_of_index(F.col("aqi")).alias("severity")).agg(F.sum("_n").alias("hours"))


def regional(fact: DataFrame, dim: DataFrame, key: str, entity: str, regions: DataFrame,
             region: str = "region") -> DataFrame:
    """Means per region. The star has no region, so ``regions`` maps entity names to one.

    Every hour of the fact counts once: of several regions of an entity the first by name is taken,
    and entities without one are reported as ``unknown``.
    """
    named = _sums(fact, key).join(dim.select(key, entity), key, "left")
    one = regions.where(F.col(region).isNotNull()).groupBy(entity).agg(F.min(region).alias(region))
    placed = lookup_join(named, one, entity, "left").withColumn(region, F.coalesce(region, F.lit("unknown")))
    return placed.groupBy(region).agg(*_means())
