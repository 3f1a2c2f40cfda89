"""Background checks, licences, text messages and support tickets."""

from ..contract import Contract, Field, Rule, Source
from ..operators.quality import not_null
from ..plans import marts
from ._build import DAILY, bronze, gold, silver

D = "operations"

# The patterns of a licence document, one field per line.
LICENCE_PATTERNS = {
    "full_name": r"Name:\s+(.+)",
    "licence_number": r"Licence No:\s+(\S+)",
    "date_of_birth": r"DOB:\s+(\d{4}-\d{2}-\d{2})",
    "expiry_date": r"EXP:\s+(\d{4}-\d{2}-\d{2})",
    "vehicle_classes": r"Classes:\s+(.+)",
}

# Columns, links, rules, masks and vocabularies of the contracts below.
BRONZE = (
    bronze("checkr_background_checks", D, """report_id driver_id full_name date_of_birth ssn_last_four licence_number
        address status result completed_at created_at adjudication""", folders=DAILY,
        pii=("driver_id", "full_name", "date_of_birth", "ssn_last_four", "licence_number", "address"),
        fks={"driver_id": "bronze_driver_profiles.driver_id"}),
    Contract(
        "bronze_checkr_driver_licences", "bronze", D,
        (Field("file_path"), *[
            Field(n, "date" if n in ("date_of_birth", "expiry_date") else "string", extract=p)
            for n, p in LICENCE_PATTERNS.items()]),
        source=Source("text", "driver_licences", "full"), rules=(not_null("licence_number"),), strategy="append",
        unknown_fields="allow", cast_to_string=True),
    bronze("twilio_sms_logs", D, """message_sid recipient_phone sender_phone message_body status direction num_segments
        price price_unit sent_at delivered_at error_code""", pii=("recipient_phone", "sender_phone", "message_body")),
    bronze("zendesk_support_tickets", D, """ticket_id entry_point rider_id trip_id driver_id charge_id requester_email
        requester_name requester_phone subject ticket_description status priority channel assignee tags_json created_at
        updated_at solved_at satisfaction_rating""", fks={"rider_id": "bronze_rider_profiles.rider_id", "trip_id": "bronze_trip_completed.trip_id",
             "driver_id": "bronze_driver_profiles.driver_id", "charge_id": "bronze_stripe_charges.charge_id"},
        pii=("requester_email", "requester_name", "requester_phone", "ticket_description")),
)

SILVER = (
    silver("checkr_driver_licences", D, """full_name! licence_number! date_of_birth expiry_date:date vehicle_classes""",
        "bronze_checkr_driver_licences", key="licence_number", unique=("licence_number",), drop=("file_path",),
        hash=("licence_number", "date_of_birth"), redact=("full_name",)),
    silver("checkr_driver_verifications", D, """report_id! driver_id! full_name date_of_birth ssn_last_four
        licence_number address status result completed_at:timestamp created_at:timestamp adjudication""",
        "bronze_checkr_background_checks", key="report_id", unique=("report_id",),
        hash=("driver_id", "date_of_birth", "ssn_last_four", "licence_number"), redact=("full_name", "address")),
    silver("twilio_sms_logs", D, """message_sid! recipient_phone sender_phone message_body status direction
        num_segments:integer price:float price_unit sent_at:timestamp delivered_at:timestamp error_code""",
        "bronze_twilio_sms_logs", key="message_sid", unique=("message_sid",), registered=False,
        rules=(Rule("message_sid_not_null", "message_sid IS NOT NULL"),
               Rule("valid_status", "status IN ('delivered', 'failed', 'undelivered', 'sent', 'queued')")),
        hash=("recipient_phone", "sender_phone"), redact=("message_body",)),
    silver("zendesk_support_tickets", D, """ticket_id! entry_point rider_id trip_id driver_id charge_id
        requester_email! requester_name requester_phone subject ticket_description status priority channel assignee
        tags_json created_at:timestamp updated_at:timestamp solved_at:timestamp satisfaction_rating:float""",
        "bronze_zendesk_support_tickets", key="ticket_id", unique=("ticket_id",), hash=("requester_email",),
        redact=("requester_name", "requester_phone"), fks={"rider_id": "silver_rider_profiles.rider_id", "trip_id": "silver_trips.trip_id",
             "driver_id": "silver_driver_profiles.driver_id", "charge_id": "silver_stripe_charges.charge_id"}),
)

_LABELS = {
    # The vocabularies of the ticket labels.
    "category": ("billing_dispute", "refund_request", "driver_complaint", "rider_complaint", "app_issue", "lost_item",
                 "safety_incident", "account", "promo_question", "other"),
    "intent": ("refund", "cancel", "complain", "inquire", "report_bug", "praise"),
    "sentiment": ("positive", "neutral", "negative"),
}

GOLD = (
    gold("fact_ticket_enriched", D, """ticket_id! entry_point rider_id rider_sk trip_id driver_id driver_sk charge_id
        created_at:timestamp persons organizations locations category intent sentiment sentiment_score:float
        urgency_score:float""", "silver_zendesk_support_tickets", key="ticket_id",
        links={"dim_rider": "gold_dim_rider", "dim_driver": "gold_dim_driver"},
        transform=lambda i: marts.ticket_enriched(i["source"], i["dim_rider"], i["dim_driver"]),
        rules=(not_null("sentiment"), not_null("category")), accepted=_LABELS,
        fks={"ticket_id": "silver_zendesk_support_tickets.ticket_id", "rider_id": "gold_dim_rider.rider_id",
             "rider_sk": "gold_dim_rider.rider_sk", "trip_id": "silver_trips.trip_id",
             "driver_id": "gold_dim_driver.driver_id", "driver_sk": "gold_dim_driver.driver_sk",
             "charge_id": "silver_stripe_charges.charge_id"}),
)
