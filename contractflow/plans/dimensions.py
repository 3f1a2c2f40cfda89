"""Dimension specifications and the generated calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Scd2
from ..functions.calendar import calendar_columns

DRIVER = Scd2(
    surrogate_key="driver_sk", timestamp="updated_at", version="version_number", buckets=16,
    track=("licence_plate", "vehicle_type", "city_code", "status", "licence_number"),
)
RIDER = Scd2(
    surrogate_key="rider_sk", timestamp="updated_at", buckets=16,
    track=("city_code", "home_address", "status", "preferred_payment_method"),
)
CITY = Scd2(
    surrogate_key="city_sk", track=("geofence_wkt", "timezone", "default_currency", "is_active"),
)


def calendar_between(bounds: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Date dimension rows for the span of ``bounds`` (one row: first_date, last_date).

    ``holidays`` has ``holiday_date`` and ``country`` (``us`` or ``uk``); without it no
    day is a holiday.
    """
    days = bounds.select(F.explode(F.sequence("first_date", "last_date")).alias("d"))
    out = days.select(*[c.alias(n) for n, c in calendar_columns(F.col("d")).items()])
    if holidays is None:
        return out.withColumns({"is_holiday_us": F.lit(False), "is_holiday_uk": F.lit(False)})
    flags = holidays.groupBy(F.col("holiday_date").alias("full_date")).agg(
        F.bool_or(F.col("country") == "us").alias("is_holiday_us"),
        F.bool_or(F.col("country") == "uk").alias("is_holiday_uk"),
    )
    return out.join(flags, "full_date", "left").fillna(False, ["is_holiday_us", "is_holiday_uk"])


def date_dimension(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31",
                   holidays: DataFrame | None = None) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("first_date"), F.lit(end).cast("date").alias("last_date"))
    return calendar_between(bounds, holidays)
