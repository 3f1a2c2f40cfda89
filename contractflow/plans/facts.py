"""Daily facts and scorecards. Every function takes and returns DataFrames and is lazy.

``scale`` names the number of decimals of the amounts and makes their sums exact;
without it they are double sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import date_key
from ..functions.numeric import mean, positive_ratio, total
from ..operators.asof import asof_by_day, current_version, or_unknown
from ..operators.merge import changed_keys, restrict_to_changed, restrict_to_days


def trip_daily_kpis(trips: DataFrame, changed: DataFrame | None = None, *, scale: int | None = None) -> DataFrame:
    """Trips, revenue, distance and averages per day and city.

    With ``changed`` (newly arrived trips) only their days are computed, from all trips.
    """
    dated = trips.filter(F.col("requested_at").isNotNull())
    if changed is not None:
        days = changed_keys(changed, F.to_date("requested_at"), "day")
        dated = restrict_to_days(dated, "requested_at", days)
    return dated.groupBy(F.to_date("requested_at").alias("kpi_date"), "city_code").agg(
        F.count(F.lit(1)).cast("int").alias("total_trips"),
        total(F.col("fare_amount"), scale).alias("total_revenue"),
        total(F.col("distance_km"), scale).alias("total_distance_km"),
        mean(F.col("fare_amount"), scale).alias("avg_fare"),
        mean(F.col("surge_multiplier"), scale).alias("avg_surge"),
    )


def driver_scorecard(trips: DataFrame, dim_driver: DataFrame, changed: DataFrame | None = None, *,
                     scale: int | None = None) -> DataFrame:
    """Lifetime figures per driver with the surrogate key of the current version."""
    known = trips.filter(F.col("driver_id").isNotNull())
    if changed is not None:
        known = restrict_to_changed(known, F.col("driver_id"), changed_keys(changed, F.col("driver_id"), "k"))
    figures = known.groupBy("driver_id").agg(
        F.count(F.lit(1)).cast("int").alias("total_trips"),
        total(F.col("fare_amount"), scale).alias("total_earnings"),
        mean(F.col("driver_rating"), scale).alias("avg_driver_rating"),
        mean(F.col("distance_km"), scale).alias("avg_distance_km"),
        mean(F.col("duration_minutes"), scale).alias("avg_duration_minutes"),
    )
    current = current_version(dim_driver).select("driver_id", "driver_sk")
    return figures.join(current, "driver_id", "left").withColumn("driver_sk", or_unknown(F.col("driver_sk")))


def rider_daily_metrics(trips: DataFrame, dim_rider: DataFrame, changed: DataFrame | None = None, *,
                        scale: int | None = None) -> DataFrame:
    """Trips, spend, tips and rating per rider and day, keyed to the version of that day."""
    known = trips.filter(F.col("rider_id").isNotNull() & F.col("requested_at").isNotNull())
    if changed is not None:
        days = changed_keys(changed, F.to_date("requested_at"), "day")
        known = restrict_to_days(known, "requested_at", days)
    figures = known.groupBy("rider_id", F.to_date("requested_at").alias("activity_date")).agg(
        F.count(F.lit(1)).cast("int").alias("daily_trips"),
        total(F.col("fare_amount"), scale).alias("daily_spend"),
        total(F.col("tip_amount"), scale).alias("daily_tips"),
        mean(F.col("rider_rating"), scale).alias("avg_daily_rating"),
    )
    keyed = asof_by_day(figures, dim_rider, ["rider_id"], "activity_date", ["rider_sk"])
    return keyed.withColumn("rider_sk", or_unknown(F.col("rider_sk")))


def payment_reconciliation(charges: DataFrame, *, scale: int | None = None) -> DataFrame:
    """Counts and amounts of charges by outcome, per day and currency."""
    succeeded = F.col("status") == "succeeded"
    amount = F.col("amount")
    out = charges.groupBy(
        F.to_date("created_at").cast("string").alias("created_date"), "currency"
    ).agg(
        F.count(F.lit(1)).alias("total_charges"),
        F.count_if(succeeded).alias("succeeded_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
        F.count_if(F.col("status") == "pending").alias("pending_count"),
        total(amount, scale).alias("total_amount"),
        total(F.when(succeeded, amount).otherwise(F.lit(0.0)), scale).alias("success_amount"),
    )
    return out.withColumn("success_rate", positive_ratio(F.col("succeeded_count"), F.col("total_charges")))


def acquisition_roi(campaigns: DataFrame, *, scale: int | None = None) -> DataFrame:
    """Ad spend, reach and return per day."""
    sums = campaigns.groupBy("date").agg(
        total(F.col("cost"), scale).alias("total_cost"),
        F.sum(F.col("impressions").cast("long")).alias("total_impressions"),
        F.sum(F.col("clicks").cast("long")).alias("total_clicks"),
        F.sum(F.col("conversions").cast("long")).alias("total_conversions"),
        total(F.col("conversion_value").try_cast("double"), scale).alias("total_conversion_value"),
    )
    c = F.col
    return sums.withColumns({
        "cac": positive_ratio(c("total_cost"), c("total_conversions")),
        "ctr": positive_ratio(c("total_clicks"), c("total_impressions")),
        "conversion_rate": positive_ratio(c("total_conversions"), c("total_clicks")),
        "roas": positive_ratio(c("total_conversion_value"), c("total_cost")),
    })


def fx_rates_with_date_key(rates: DataFrame) -> DataFrame:
    """Daily exchange rates with the key of their calendar day."""
    return rates.withColumn("date_key", date_key(F.col("rate_date")))
