"""Riders, drivers, trips and telemetry."""

from ..contract import Rule, Source
from ..plans import dimensions, facts
from ._build import bronze, gold, silver

D = "marketplace"

# Columns, links, rules, masks and vocabularies of the contracts below.
BRONZE = (
    bronze("driver_profiles", D, """driver_id name email phone date_of_birth home_address licence_number licence_plate
        vehicle_type bank_account_last_four city_code signup_date status rating updated_at""",
        pii=("name", "email", "phone", "date_of_birth", "home_address", "licence_number")),
    bronze("driver_telemetry", D, """telemetry_id driver_id gps_lat gps_lng speed_kmh heading accuracy_meters trip_id
        status city_code timestamp"""),
    bronze("rider_app_events", D, """event_id rider_id device_id ip_address event_name screen_name event_timestamp
        app_version platform city_code event_properties_json""", pii=("device_id", "ip_address")),
    bronze("rider_profiles", D, """rider_id name email phone date_of_birth home_address city_code signup_date status
        preferred_payment_method updated_at""", pii=("name", "email", "phone", "date_of_birth", "home_address")),
    bronze("trip_cancellations", D, """cancellation_id trip_id rider_id driver_id cancelled_by cancel_reason_code
        city_code requested_at cancelled_at cancellation_fee"""),
    bronze("trip_completed", D, """trip_id rider_id driver_id trip_type pickup_lat pickup_lng dropoff_lat dropoff_lng
        city_code requested_at pickup_at dropoff_at distance_km duration_minutes fare_amount surge_multiplier
        tip_amount payment_method rider_rating driver_rating notes""", pii=("notes",),
        accepted={"trip_type": ("ride", "eats_delivery"), "city_code": ("LON", "NYC", "BER", "PAR", "TYO", "SYD")}),
    bronze("trip_requests", D, """request_id rider_id trip_type pickup_lat pickup_lng dropoff_lat dropoff_lng city_code
        requested_at estimated_fare estimated_eta_minutes surge_multiplier""", fmt="json"),
)

_RIDER = "silver_rider_profiles.rider_id"
_DRIVER = "silver_driver_profiles.driver_id"
_DROP = dict(unknown="drop")

SILVER = (
    silver("driver_profiles", D, """driver_id! name email phone date_of_birth home_address licence_number licence_plate
        vehicle_type bank_account_last_four city_code signup_date:date status rating:float updated_at:timestamp""",
        "bronze_driver_profiles", key="driver_id", latest_by="updated_at",
        rules=(Rule("valid_licence_number", "licence_number IS NOT NULL"), Rule("valid_email", "email LIKE '%@%'")),
        hash=("email", "phone", "date_of_birth", "licence_number", "licence_plate", "bank_account_last_four"),
        redact=("name", "home_address"), **_DROP),
    silver("driver_telemetry", D, """telemetry_id! driver_id! gps_lat gps_lng speed_kmh:float heading accuracy_meters
        trip_id status city_code timestamp:timestamp""", "bronze_driver_telemetry", key="telemetry_id",
        unique=("telemetry_id",), **_DROP),
    silver("rider_app_events", D, """event_id! rider_id! device_id ip_address event_name! screen_name
        event_timestamp:timestamp! app_version platform city_code event_properties_json""",
        "bronze_rider_app_events", key="event_id",
        rules=(Rule("event_id_not_null", "event_id IS NOT NULL"), Rule("rider_id_not_null", "rider_id IS NOT NULL"),
               Rule("valid_platform", "platform IS NULL OR platform IN ('ios', 'android')")),
        unique=("event_id",), hash=("rider_id", "device_id"), redact=("ip_address",), fks={"rider_id": _RIDER},
        registered=False, **_DROP),
    silver("rider_profiles", D, """rider_id! name email phone date_of_birth home_address city_code signup_date:date
        status preferred_payment_method updated_at:timestamp""", "bronze_rider_profiles", key="rider_id",
        rules=(Rule("valid_email", "email LIKE '%@%'"), Rule("rider_id_not_null", "rider_id IS NOT NULL")),
        unique=("rider_id",), hash=("email", "phone", "date_of_birth"), redact=("name", "home_address"), **_DROP),
    silver("trip_cancellations", D, """cancellation_id! trip_id rider_id! driver_id cancelled_by cancel_reason_code
        city_code requested_at:timestamp cancelled_at:timestamp! cancellation_fee:float""",
        "bronze_trip_cancellations", key="cancellation_id",
        rules=(Rule("cancellation_id_not_null", "cancellation_id IS NOT NULL"),
               Rule("valid_cancelled_by", "cancelled_by IS NULL OR cancelled_by IN ('rider', 'driver')"),
               Rule("cancelled_after_requested",
                    "requested_at IS NULL OR cancelled_at IS NULL OR cancelled_at >= requested_at", "temporal")),
        unique=("cancellation_id",), hash=("rider_id", "driver_id"), fks={"rider_id": _RIDER, "driver_id": _DRIVER},
        **_DROP),
    silver("trip_requests", D, """request_id! rider_id! trip_type pickup_lat:float pickup_lng:float dropoff_lat:float
        dropoff_lng:float city_code requested_at:timestamp! estimated_fare:float estimated_eta_minutes:integer
        surge_multiplier:float""", "bronze_trip_requests", key="request_id",
        rules=(Rule("request_id_not_null", "request_id IS NOT NULL"), Rule("rider_id_not_null", "rider_id IS NOT NULL"),
               Rule("valid_trip_type", "trip_type IS NULL OR trip_type IN ('ride', 'eats_delivery')"),
               Rule("surge_in_range",
                    "surge_multiplier IS NULL OR (surge_multiplier >= 1.0 AND surge_multiplier <= 10.0)", "range")),
        unique=("request_id",), hash=("rider_id",), fks={"rider_id": _RIDER}, **_DROP),
    silver("trips", D, """trip_id! rider_id! driver_id! trip_type pickup_lat pickup_lng dropoff_lat dropoff_lng
        city_code requested_at:timestamp pickup_at:timestamp dropoff_at:timestamp distance_km:float
        duration_minutes:integer fare_amount:float surge_multiplier:float tip_amount:float payment_method
        rider_rating:float driver_rating:float notes""", "bronze_trip_completed", key="trip_id",
        rules=(Rule("positive_spend", "fare_amount >= 0", "range"),
               Rule("valid_rating", "rider_rating IS NULL OR (rider_rating >= 1.0 AND rider_rating <= 5.0)", "range")),
        **_DROP),
)

_TRIPS = "silver_trips"

_STRICT = dict(evolution="strict")  # of products that a transform builds; the landed inferences may lack optional columns

GOLD = (
    gold("dim_driver", D, """driver_id! name email phone licence_number licence_plate vehicle_type city_code status
        rating:float signup_date:date updated_at:timestamp""", "silver_driver_profiles", key="driver_id",
        natural_key="driver_id effective_from", strategy="scd2", scd2=dimensions.DRIVER, unique=("driver_sk",),
        pii=("name", "email", "phone", "licence_number"), **_STRICT),
    gold("dim_rider", D, """rider_id! name email phone home_address city_code status preferred_payment_method
        signup_date:date updated_at:timestamp""", "silver_rider_profiles", key="rider_id",
        natural_key="rider_id effective_from", strategy="scd2", scd2=dimensions.RIDER, unique=("rider_sk",),
        pii=("name", "email", "phone", "home_address"), **_STRICT),
    gold("fact_trip_daily_kpis", D, """kpi_date:date! city_code total_trips:integer total_revenue:float
        total_distance_km:float avg_fare:float avg_surge:float""", _TRIPS, key="kpi_date city_code", partition_by=("kpi_date",),
        links={"silver_trips_full": _TRIPS},
        transform=lambda i: facts.trip_daily_kpis(i["silver_trips_full"], i["source"]), **_STRICT),
    gold("dim_driver_scorecard", D, """driver_id! driver_sk total_trips:integer total_earnings:float
        avg_driver_rating:float avg_distance_km:float avg_duration_minutes:float""", _TRIPS, key="driver_id",
        links={"silver_trips_full": _TRIPS, "dim_driver": "gold_dim_driver"},
        fks={"driver_sk": "gold_dim_driver.driver_sk"},
        transform=lambda i: facts.driver_scorecard(i["silver_trips_full"], i["dim_driver"], i["source"]), **_STRICT),
    gold("fact_rider_daily_metrics", D, """rider_sk! rider_id! activity_date:date! daily_trips:integer
        daily_spend:float daily_tips:float avg_daily_rating:float""", _TRIPS, key="rider_id activity_date", partition_by=("activity_date",),
        links={"silver_trips_full": _TRIPS, "dim_rider": "gold_dim_rider"},
        fks={"rider_sk": "gold_dim_rider.rider_sk"},
        transform=lambda i: facts.rider_daily_metrics(i["silver_trips_full"], i["dim_rider"], i["source"]), **_STRICT),
    gold("fact_surge_pricing_inference", D, """inference_id! model_version! city_code demand_index:float
        surge_multiplier:float! timestamp:timestamp!""", Source("parquet", "surge_inference_landing"),
        key="inference_id", unique=("inference_id",), registered=False,
        rules=(Rule("valid_surge_bounds", "surge_multiplier >= 1.0 AND surge_multiplier <= 5.0", "range"),
               Rule("demand_index_bounds", "demand_index >= 0.0 AND demand_index <= 10.0", "range"))),
)
