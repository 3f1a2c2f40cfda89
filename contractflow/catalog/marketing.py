"""Advertising, analytics and messaging campaigns."""

from ..contract import Rule
from ..plans import facts
from ._build import bronze, gold, silver

D = "marketing"

# Columns, links, rules, masks and vocabularies of the contracts below.
BRONZE = (
    bronze("google_ads_campaigns", D, """campaign_id campaign_name ad_group_id ad_group_name date impressions clicks
        cost conversions conversion_value currency"""),
    bronze("google_analytics_app_events", D, """event_name event_timestamp event_date user_pseudo_id user_id device_id
        ip_address device_category device_os geo_country geo_city app_version event_params_json""",
        pii=("user_id", "device_id", "ip_address")),
    bronze("google_analytics_sessions", D, """session_id user_pseudo_id user_id ip_address session_start
        session_duration_seconds page_views traffic_source traffic_medium traffic_campaign device_category geo_country
        landing_page""", pii=("user_id", "ip_address")),
    bronze("hubspot_email_campaigns", D, """campaign_id recipient_email recipient_name campaign_name subject_line
        sent_at opened_at clicked_at bounced unsubscribed""", pii=("recipient_email", "recipient_name")),
    bronze("hubspot_push_notifications", D, """notification_id rider_id device_token campaign_name sent_at delivered_at
        opened_at platform""", pii=("rider_id", "device_token"), fks={"rider_id": "bronze_rider_profiles.rider_id"}),
    bronze("meta_ads_campaigns", D, """campaign_id campaign_name adset_id adset_name date impressions clicks spend
        actions_json conversions currency"""),
)

_EVENT_KEY = "event_timestamp event_name user_pseudo_id"

SILVER = (
    silver("google_ads_campaigns", D, """campaign_id! campaign_name! ad_group_id ad_group_name date impressions:integer
        clicks:integer cost:float conversions:integer conversion_value currency""", "bronze_google_ads_campaigns",
        key="campaign_id ad_group_id date"),
    silver("google_analytics_app_events", D, """event_name! event_timestamp:timestamp! event_date:date user_pseudo_id!
        user_id device_id ip_address device_category device_os geo_country geo_city app_version event_params_json""",
        "bronze_google_analytics_app_events", key=_EVENT_KEY, unique=(_EVENT_KEY,), registered=False,
        rules=(Rule("event_name_not_null", "event_name IS NOT NULL"),
               Rule("pseudo_id_not_null", "user_pseudo_id IS NOT NULL"),
               Rule("valid_device_category",
                    "device_category IS NULL OR device_category IN ('mobile', 'tablet', 'desktop')")),
        hash=("user_id", "device_id"), redact=("ip_address",),
        # The exports hold the event time as microseconds since the epoch, as text.
        formats={"event_timestamp": "epoch_micros"}),
    silver("google_analytics_sessions", D, """session_id! user_pseudo_id! user_id ip_address session_start
        session_duration_seconds:integer page_views traffic_source traffic_medium traffic_campaign device_category
        geo_country landing_page""", "bronze_google_analytics_sessions", key="session_id", unique=("session_id",),
        hash=("user_id",), redact=("ip_address",)),
    silver("hubspot_email_campaigns", D, """campaign_id! recipient_email! recipient_name campaign_name subject_line
        sent_at:timestamp opened_at:timestamp clicked_at:timestamp bounced:boolean unsubscribed:boolean""",
        "bronze_hubspot_email_campaigns", key="campaign_id", unique=("campaign_id",), hash=("recipient_email",),
        redact=("recipient_name",)),
    silver("hubspot_push_notifications", D, """notification_id! rider_id device_token campaign_name sent_at:timestamp
        delivered_at:timestamp opened_at:timestamp platform""", "bronze_hubspot_push_notifications",
        key="notification_id", unique=("notification_id",), registered=False,
        rules=(Rule("notification_id_not_null", "notification_id IS NOT NULL"),
               Rule("valid_platform", "platform IS NULL OR platform IN ('ios', 'android')")),
        hash=("rider_id", "device_token"), fks={"rider_id": "silver_rider_profiles.rider_id"}),
    silver("meta_ads_campaigns", D, """campaign_id! campaign_name! adset_id adset_name date impressions:integer
        clicks:integer spend actions_json conversions:integer currency""", "bronze_meta_ads_campaigns",
        key="campaign_id", unique=("campaign_id",)),
)

GOLD = (
    gold("agg_acquisition_roi", D, """date! total_cost:float total_impressions:long total_clicks:long
        total_conversions:long total_conversion_value:float cac:float ctr:float conversion_rate:float roas:float""",
        "silver_google_ads_campaigns", key="date", links={"silver_campaigns_full": "silver_google_ads_campaigns"},
        transform=lambda i: facts.acquisition_roi(i["silver_campaigns_full"])),
)
