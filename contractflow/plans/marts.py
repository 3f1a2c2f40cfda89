"""Cross-domain products.

Each mart aggregates every input to its own grain first and joins the small results,
so a hot day, city or campaign is reduced on the map side before any join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio, total
from ..functions.text import OrderedRules, TextRule, classify, joined_lower_text, score_lookup
from ..operators.asof import asof_by_time, or_unknown
from ..operators.dedup import deduplicate_by_latest


def driver_360(drivers: DataFrame, verifications: DataFrame, payouts: DataFrame, *,
               scale: int | None = None) -> DataFrame:
    """One row per driver profile with the newest background check and lifetime payouts."""
    paid = payouts.groupBy("driver_id").agg(
        total(F.col("amount"), scale).alias("lifetime_payout_amount"),
        F.max("arrival_date").cast("string").alias("last_payout_date"),
    )
    checks = deduplicate_by_latest(
        verifications.filter(F.col("driver_id").isNotNull()).select("driver_id", "completed_at", "status"),
        ["driver_id"], "completed_at",
    ).select("driver_id", F.col("status").alias("_check"), F.col("completed_at").alias("verification_completed_at"))
    return (
        drivers.join(checks, "driver_id", "left").join(paid, "driver_id", "left").select(
            "driver_id", F.col("name").alias("full_name"), "email", "city_code", "status",
            F.col("rating").cast("double").alias("rating"),
            F.coalesce("_check", F.lit("unverified")).alias("verification_status"),
            "verification_completed_at",
            F.coalesce("lifetime_payout_amount", F.lit(0.0)).alias("lifetime_payout_amount"),
            "last_payout_date",
        )
    )


# Share of the fare the platform keeps, and the reporting currency.
COMMISSION_RATE = 0.25
REPORTING_CURRENCY = "GBP"


def revenue_daily(charges: DataFrame, trips: DataFrame, drivers: DataFrame, refunds: DataFrame,
                  payouts: DataFrame, *, scale: int | None = None, null_safe: bool = False) -> DataFrame:
    """Revenue, commission, refunds and payouts per day, city and vehicle type.

    The payouts of a group are the lifetime payouts of the drivers in it. By default a
    NULL city or vehicle type finds no refunds or payouts; ``null_safe`` changes that.
    """
    grain = ["kpi_date", "city_code", "vehicle_type"]
    # Refunds are added up per charge before they meet the charge.
    refunded = refunds.groupBy("charge_id").agg(
        total(F.col("amount"), scale).alias("_refunded"), F.count("refund_id").alias("_refunds")
    )
    priced = (
        charges.select(F.to_date("created_at").alias("kpi_date"), "trip_id", "charge_id", "amount")
        .join(trips.select("trip_id", "city_code", "driver_id"), "trip_id")
        .join(drivers.select("driver_id", "vehicle_type"), "driver_id", "left")
        .join(refunded, "charge_id", "left")
    )
    # All measures come from this one pass: per trip, then per driver, then per group.
    # A trip has one driver; should it have more, it counts with the first of them.
    per_trip = priced.groupBy(*grain, "trip_id").agg(
        total(F.col("amount"), scale).alias("_gross"),
        total(F.col("_refunded"), scale).alias("_refunded"),
        F.sum("_refunds").alias("_refunds"),
        F.collect_set("driver_id").alias("_drivers"),
    )
    per_driver = (
        per_trip.select("*", F.posexplode_outer("_drivers").alias("_pos", "driver_id"))
        .withColumn("_counts", F.coalesce("_pos", F.lit(0)) == 0)
        .groupBy(*grain, "driver_id")
        .agg(
            total(F.when(F.col("_counts"), F.col("_gross")), scale).alias("_gross"),
            total(F.when(F.col("_counts"), F.col("_refunded")), scale).alias("_refunded"),
            F.sum(F.when(F.col("_counts"), F.col("_refunds"))).alias("_refunds"),
            F.count_if(F.col("_counts")).alias("_trips"),
        )
    )
    paid = payouts.groupBy("driver_id").agg(total(F.col("amount"), scale).alias("_paid"))
    groups = per_driver.join(paid, "driver_id", "left").groupBy(*grain).agg(
        total(F.col("_gross"), scale).alias("gross_revenue_amount"),
        total(F.col("_refunded"), scale).alias("_refunded"),
        F.sum("_refunds").alias("_refunds"),
        total(F.col("_paid"), scale).alias("_paid"),
        F.sum("_trips").cast("int").alias("trip_count"),
    )
    whole_key = F.lit(True)
    if not null_safe:
        for g in grain:
            whole_key = whole_key & F.col(g).isNotNull()
    refund = F.coalesce(F.when(whole_key, F.col("_refunded")), F.lit(0.0))
    return groups.select(
        *grain, "gross_revenue_amount",
        (F.col("gross_revenue_amount") * COMMISSION_RATE).alias("platform_commission_amount"),
        F.coalesce(F.when(whole_key, F.col("_paid")), F.lit(0.0)).alias("driver_payout_amount"),
        refund.alias("refund_amount"),
        F.coalesce(F.when(whole_key, F.col("_refunds")), F.lit(0)).cast("int").alias("refund_count"),
        (F.col("gross_revenue_amount") - refund).alias("net_revenue_amount"),
        "trip_count",
        F.lit(REPORTING_CURRENCY).alias("currency"),
    )


# The channel names.
GOOGLE, META, EMAIL = "google_ads", "meta_ads", "hubspot_email"


def acquisition_cost(google: DataFrame, meta: DataFrame, email: DataFrame, *, scale: int | None = None) -> DataFrame:
    """Spend and reach per day, channel and campaign. Attribution columns stay NULL."""

    def channel(df: DataFrame, name: str, day, spend, impressions, clicks) -> DataFrame:
        return df.select(
            F.to_date(day).alias("kpi_date"), F.lit(name).alias("channel"), "campaign_id", "campaign_name",
            spend.alias("spend"), impressions.cast("long").alias("impressions"), clicks.cast("long").alias("clicks"),
        )

    opened = F.col("clicked_at").isNotNull().cast("int")
    rows = (
        channel(google, GOOGLE, "date", F.col("cost").try_cast("double"),
                F.col("impressions").try_cast("int"), F.col("clicks").try_cast("int"))
        .unionByName(channel(meta, META, "date", F.col("spend").try_cast("double"),
                             F.col("impressions").try_cast("int"), F.col("clicks").try_cast("int")))
        .unionByName(channel(email, EMAIL, "sent_at", F.lit(0.0), F.lit(1), opened))
    )
    # Added up by name first: that is a hash aggregate. A maximum of text would sort every input row.
    named = rows.groupBy("kpi_date", "channel", "campaign_id", "campaign_name").agg(
        total(F.col("spend"), scale).alias("spend"), F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"))
    return named.groupBy("kpi_date", "channel", "campaign_id").agg(
        F.max("campaign_name").alias("campaign_name"),
        total(F.col("spend"), scale).alias("spend_amount"),
        F.sum("impressions").cast("int").alias("impressions"),
        F.sum("clicks").cast("int").alias("clicks"),
        F.first(F.lit(None).cast("int")).alias("attributed_new_riders"),
        F.first(F.lit(None).cast("double")).alias("cost_per_acquisition"),
        F.first(F.lit(None).cast("double")).alias("conversion_rate"),
    )


def marketplace_health(requests: DataFrame, trips: DataFrame, cancellations: DataFrame, charges: DataFrame, *,
                       scale: int | None = None) -> DataFrame:
    """Volume, rates, supply and revenue per day and city, all dated by the request.

    Charges are added up per trip and meet the trips once, so trips are read once for
    volume, supply and revenue. The three aggregates become rows of one union at (day,
    city), and one more aggregation replaces a key spine with a join per measure. A
    NULL city shows no measures, as a join on it would find none.
    """
    day = F.to_date("requested_at").alias("kpi_date")
    asked = requests.groupBy(day, "city_code").agg(
        F.count(F.lit(1)).alias("requested"), F.count_distinct("rider_id").alias("riders"))
    paid = charges.groupBy("trip_id").agg(total(F.col("amount"), scale).alias("_amount"))
    done = trips.select("trip_id", day, "city_code", "driver_id").join(paid, "trip_id", "left").groupBy(
        "kpi_date", "city_code"
    ).agg(
        F.count(F.lit(1)).alias("completed"), F.count_distinct("driver_id").alias("drivers"),
        total(F.col("_amount"), scale).alias("revenue"),
    )
    cancelled = cancellations.groupBy(day, "city_code").agg(F.count(F.lit(1)).alias("cancelled"))
    measures = ["requested", "riders", "completed", "drivers", "cancelled", "revenue"]
    grain = ["kpi_date", "city_code"]
    rows = asked.unionByName(done, allowMissingColumns=True).unionByName(cancelled, allowMissingColumns=True)
    one = rows.groupBy(*grain).agg(*[F.max(m).alias(m) for m in measures])
    # A join on NULL matches nothing, so such a key shows no measures at all.
    joined = F.col("kpi_date").isNotNull() & F.col("city_code").isNotNull()
    m = {name: F.when(joined, F.col(name)) for name in measures}

    def count(name: str):
        return F.coalesce(m[name], F.lit(0)).cast("int")

    gross = F.coalesce(m["revenue"], F.lit(0.0))
    return one.select(
        *grain,
        count("requested").alias("requested_trips"),
        count("completed").alias("completed_trips"),
        count("cancelled").alias("cancelled_trips"),
        ratio(count("completed"), m["requested"]).alias("completion_rate"),
        ratio(count("cancelled"), m["requested"]).alias("cancellation_rate"),
        count("drivers").alias("active_drivers"),
        ratio(count("completed"), m["drivers"]).alias("driver_utilization_rate"),
        gross.alias("gross_revenue_amount"),
        ratio(gross, m["riders"]).alias("revenue_per_active_rider"),
        count("riders").alias("active_riders"),
    )


# Keyword tables of the ticket enrichment and the scores of its labels.
TICKET_CATEGORY = OrderedRules((
    TextRule("refund_request", ("refund",)),
    TextRule("lost_item", ("lost item",)),
    TextRule("safety_incident", ("safety", "unsafe", "inappropriate")),
    TextRule("promo_question", ("promo",)),
    TextRule("billing_dispute", ("double charge", "surge pricing")),
    TextRule("driver_complaint", ("never arrived", "longer route", ("driver", "cancelled"))),
    TextRule("app_issue", ("log in", "crash")),
    TextRule("account", ("phone number", "update payment method")),
), default="other")
TICKET_INTENT = OrderedRules((
    TextRule("refund", ("refund",)),
    TextRule("cancel", ("cancel",)),
    TextRule("report_bug", ("crash", "log in")),
    TextRule("complain", ("wrong", "unsafe", "inappropriate", "never arrived", "longer route", "safety",
                          "double charge")),
), default="inquire")
TICKET_SENTIMENT = OrderedRules((
    TextRule("negative", ("wrong", "unsafe", "inappropriate", "never arrived", "longer route", "double charge",
                          "cancelled", "safety", "crash", "lost item")),
), default="neutral")
SENTIMENT_SCORE = {"negative": -0.6, "positive": 0.6}
PRIORITY_SCORE = {"urgent": 0.95, "high": 0.75, "normal": 0.40, "low": 0.15}
DEFAULT_PRIORITY_SCORE = 0.40


def ticket_enriched(tickets: DataFrame, dim_rider: DataFrame, dim_driver: DataFrame, *,
                    category: OrderedRules = TICKET_CATEGORY, intent: OrderedRules = TICKET_INTENT,
                    sentiment: OrderedRules = TICKET_SENTIMENT,
                    sentiment_score: Mapping[str, float] = SENTIMENT_SCORE) -> DataFrame:
    """Tickets with labels, scores and the surrogate keys in force when they were created.

    The text is classified and dropped before the joins, so it is never shuffled.
    """
    text = joined_lower_text(F.col("subject"), F.col("ticket_description"))
    kept = ["ticket_id", "entry_point", "rider_id", "trip_id", "driver_id", "charge_id", "created_at"]
    labelled = tickets.select(*kept, "priority", text.alias("_t")).select(
        *kept,
        *[F.lit(None).cast("string").alias(n) for n in ("persons", "organizations", "locations")],
        classify(F.col("_t"), category).alias("category"),
        classify(F.col("_t"), intent).alias("intent"),
        classify(F.col("_t"), sentiment).alias("sentiment"),
        score_lookup(F.col("priority"), PRIORITY_SCORE, DEFAULT_PRIORITY_SCORE).alias("urgency_score"),
    ).withColumn("sentiment_score", score_lookup(F.col("sentiment"), sentiment_score, 0.0))
    keyed = asof_by_time(labelled, dim_rider, ["rider_id"], "created_at", ["rider_sk"])
    keyed = asof_by_time(keyed, dim_driver, ["driver_id"], "created_at", ["driver_sk"])
    return keyed.withColumns({"rider_sk": or_unknown(F.col("rider_sk")), "driver_sk": or_unknown(F.col("driver_sk"))})
