"""Charges, refunds and payouts."""

from ..plans import facts
from ._build import DAILY, bronze, gold, silver

D = "payments"

# Columns, links, rules, masks and vocabularies of the contracts below.
BRONZE = (
    bronze("stripe_charges", D, """charge_id rider_id trip_id amount currency status payment_method_type card_last_four
        billing_email billing_address created_at metadata_json""", folders=DAILY,
        pii=("card_last_four", "billing_email", "billing_address"),
        fks={"rider_id": "bronze_rider_profiles.rider_id", "trip_id": "bronze_trip_completed.trip_id"}),
    bronze("stripe_payouts", D, """payout_id driver_id amount currency status payout_email bank_account_last_four
        arrival_date created_at""", folders=DAILY, pii=("payout_email", "bank_account_last_four"),
        fks={"driver_id": "bronze_driver_profiles.driver_id"}),
    bronze("stripe_refunds", D, """refund_id charge_id rider_id amount currency status reason refund_reason
        created_at""", folders=DAILY, pii=("refund_reason",),
        fks={"charge_id": "bronze_stripe_charges.charge_id", "rider_id": "bronze_rider_profiles.rider_id"}),
)

SILVER = (
    silver("stripe_charges", D, """charge_id! rider_id! trip_id amount:float currency status payment_method_type
        card_last_four billing_email billing_address created_at:timestamp metadata_json""", "bronze_stripe_charges",
        key="charge_id", unique=("charge_id",), hash=("card_last_four", "billing_email"), redact=("billing_address",)),
    silver("stripe_payouts", D, """payout_id! driver_id! amount:float currency status payout_email
        bank_account_last_four arrival_date:date created_at:timestamp""", "bronze_stripe_payouts", key="payout_id",
        unique=("payout_id",), hash=("payout_email", "bank_account_last_four")),
    silver("stripe_refunds", D, """refund_id! charge_id! rider_id amount:float currency status reason refund_reason
        created_at:timestamp""", "bronze_stripe_refunds", key="refund_id", unique=("refund_id",),
        hash=("refund_reason",)),
)

GOLD = (
    gold("fact_payment_reconciliation", D, """created_date! currency! total_charges:long succeeded_count:long
        failed_count:long pending_count:long total_amount:float success_amount:float success_rate:float""",
        "silver_stripe_charges", key="created_date currency",
        links={"pay_charges": "silver_stripe_charges"},
        transform=lambda i: facts.payment_reconciliation(i["pay_charges"])),
)
