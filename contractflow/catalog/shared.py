"""Cross-domain marts."""

from pyspark.sql import functions as F

from ..contract import Rule
from ..functions.masks import mask_hash
from ..plans import marts
from ._build import gold

D = "shared"


def _driver_360(i, salt: str = ""):
    """Stored background checks hold a hashed driver id, so the profiles meet them on its hash."""
    drivers = i["mp_drivers"]
    ids = drivers.select("driver_id", mask_hash(F.col("driver_id"), salt).alias("_hashed"))
    checks = i["silver_checkr_driver_verifications"].withColumnRenamed("driver_id", "_hashed")
    return marts.driver_360(drivers, checks.join(ids, "_hashed"), i["silver_stripe_payouts"])


_driver_360.takes_salt = True
_NO_DUPLICATES = dict(strategy="overwrite")

# Columns, links, rules and vocabularies of the contracts below.
GOLD = (
    gold("shared_dim_driver_360", D, """driver_id! full_name email city_code status rating:float verification_status
        verification_completed_at:timestamp lifetime_payout_amount:float last_payout_date""",
        "silver_driver_profiles", key="driver_id", unique=("driver_id",), pii=("full_name", "email"),
        links={"mp_drivers": "silver_driver_profiles",
               "silver_checkr_driver_verifications": "silver_checkr_driver_verifications",
               "silver_stripe_payouts": "silver_stripe_payouts"},
        transform=_driver_360, **_NO_DUPLICATES),
    gold("shared_fact_revenue_daily", D, """kpi_date:date! city_code vehicle_type gross_revenue_amount:float
        platform_commission_amount:float driver_payout_amount:float refund_amount:float refund_count:integer
        net_revenue_amount:float trip_count:integer currency""", "silver_stripe_charges",
        key="kpi_date city_code vehicle_type",
        links={"pay_charges": "silver_stripe_charges", "silver_trips": "silver_trips",
               "mp_drivers": "silver_driver_profiles", "silver_stripe_refunds": "silver_stripe_refunds",
               "silver_stripe_payouts": "silver_stripe_payouts"},
        transform=lambda i: marts.revenue_daily(i["pay_charges"], i["silver_trips"], i["mp_drivers"],
                                                i["silver_stripe_refunds"], i["silver_stripe_payouts"]),
        rules=(Rule("net_revenue_non_negative", "net_revenue_amount >= 0", "range"),
               Rule("refund_le_gross", "refund_amount <= gross_revenue_amount", "cross_field"),
               Rule("trip_count_positive", "trip_count >= 0", "range")), **_NO_DUPLICATES),
    gold("shared_mart_acquisition_cost", D, """kpi_date:date! channel! campaign_id! campaign_name spend_amount:float
        impressions:integer clicks:integer attributed_new_riders:integer cost_per_acquisition:float
        conversion_rate:float""", "silver_google_ads_campaigns", key="kpi_date channel campaign_id",
        links={"mkt_google": "silver_google_ads_campaigns", "silver_meta_ads_campaigns": "silver_meta_ads_campaigns",
               "silver_hubspot_email_campaigns": "silver_hubspot_email_campaigns"},
        transform=lambda i: marts.acquisition_cost(i["mkt_google"], i["silver_meta_ads_campaigns"],
                                                   i["silver_hubspot_email_campaigns"]),
        rules=(Rule("spend_non_negative", "spend_amount >= 0", "range"),
               Rule("valid_channel", "channel IN ('google_ads', 'meta_ads', 'hubspot_email')", "domain"),
               Rule("clicks_le_impressions", "impressions IS NULL OR clicks IS NULL OR clicks <= impressions",
                    "cross_field")), **_NO_DUPLICATES),
    gold("shared_mart_marketplace_health", D, """kpi_date:date! city_code! requested_trips:integer
        completed_trips:integer cancelled_trips:integer completion_rate:float cancellation_rate:float
        active_drivers:integer driver_utilization_rate:float gross_revenue_amount:float revenue_per_active_rider:float
        active_riders:integer""", "silver_trip_requests", key="kpi_date city_code",
        links={"mp_requests": "silver_trip_requests", "mp_trips": "silver_trips",
               "mp_cancels": "silver_trip_cancellations", "pay_charges": "silver_stripe_charges"},
        transform=lambda i: marts.marketplace_health(i["mp_requests"], i["mp_trips"], i["mp_cancels"],
                                                     i["pay_charges"]),
        rules=(Rule("completion_rate_in_range",
                    "completion_rate IS NULL OR (completion_rate >= 0 AND completion_rate <= 1)", "range"),
               Rule("cancellation_rate_in_range",
                    "cancellation_rate IS NULL OR (cancellation_rate >= 0 AND cancellation_rate <= 1)", "range"),
               Rule("requested_ge_completed", "requested_trips >= completed_trips", "cross_field"),
               Rule("requested_ge_cancelled", "requested_trips >= cancelled_trips", "cross_field")),
        **_NO_DUPLICATES),
)
