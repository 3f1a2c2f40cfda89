"""Cities, exchange rates, calendar and seed dimensions."""

from pyspark.sql import functions as F

from ..contract import Source
from ..plans import dimensions, facts
from ._build import bronze, gold, silver

D = "reference"
_SILVER = dict(strategy="overwrite", evolution="append")

BRONZE = (
    bronze("city_master", D, """city_code city_name country_code timezone default_currency geofence_wkt launched_at
        sunset_at""", load="full", folders=None),
    bronze("fx_rates_daily", D, "rate_date base_currency quote_currency rate source_feed", folders=None),
)

SILVER = (
    silver("cities", D, """city_code! city_name country_code timezone default_currency geofence_wkt
        launched_at:timestamp sunset_at:timestamp is_active:boolean""", "bronze_city_master", dedup="city_code",
        unique=("city_code",), **_SILVER,
        # A city is active until it has an end date; an empty text is no date.
        transform=lambda i: i["source"].withColumn("is_active", F.nullif("sunset_at", F.lit("")).isNull())),
    silver("fx_rates_daily", D, "rate_date:date! base_currency! quote_currency! rate:float! source_feed",
        "bronze_fx_rates_daily", key="rate_date base_currency quote_currency", **_SILVER),
)


def _seed(name: str, spec: str, key: str):
    return gold(f"dim_{name}", D, spec, Source("csv", f"dim_{name}_seed", "full"), key=key, unique=(key,),
                strategy="overwrite")


GOLD = (
    _seed("cancellation_reason", """reason_code! reason_label actor charge_cancellation_fee:boolean
        counts_against_driver_rating:boolean severity""", "reason_code"),
    _seed("country", "country_alpha3! country_alpha2 country_name country_numeric:int region sub_region",
          "country_alpha3"),
    _seed("currency", "currency_code! currency_numeric:int currency_name symbol minor_units:int", "currency_code"),
    _seed("payment_method", """payment_method_code! payment_method_name rail requires_strong_auth:boolean
        settles_instantly:boolean""", "payment_method_code"),
    _seed("surge_tier", "surge_tier_code! multiplier_min:float multiplier_max:float display_label notify_rider:boolean",
          "surge_tier_code"),
    _seed("vehicle_type", """vehicle_type_code! vehicle_type_name passenger_capacity:int product_tier
        requires_inspection:boolean""", "vehicle_type_code"),
    gold("dim_city", D, """city_code! city_name country_code timezone default_currency geofence_wkt
        is_active:boolean""", "silver_cities", key="city_code", natural_key="city_code effective_from",
        strategy="scd2", scd2=dimensions.CITY, unique=("city_sk",)),
    gold("dim_date", D, """date_key:int! full_date:date! year:int quarter:int month:int month_name day:int
        day_of_week:int day_name is_weekend:boolean iso_week:int is_holiday_us:boolean is_holiday_uk:boolean""",
        Source("csv", "dim_date_seed", "full"), key="date_key", unique=("date_key",), strategy="overwrite",
        # The calendar is generated; a holidays input is optional.
        transform=lambda i: dimensions.date_dimension(i["source"].sparkSession, holidays=i.get("holidays"))),
    gold("fact_fx_rate_daily", D, """rate_date:date! date_key:int base_currency! quote_currency! rate:float!
        source_feed""", "silver_fx_rates_daily", key="rate_date base_currency quote_currency", strategy="overwrite",
        transform=lambda i: facts.fx_rates_with_date_key(i["source"])),
)
