import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from contractflow.catalog import CONTRACTS, policies
from contractflow.contract import Contract, fields
from contractflow.functions import calendar, classify, mask_hash, mask_redact, parse_period, ratio, score_lookup, total
from contractflow.functions.numeric import mean, positive_ratio
from contractflow.operators import slo
from contractflow.plans import facts, maintenance, marts
from contractflow.plans.dimensions import date_dimension
from contractflow.plans.pipeline import run_contract
from contractflow.plans.steps import sql_step


def test_masks(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    out = df.select(mask_hash(F.col("v")).alias("h"), mask_hash(F.col("v"), "s").alias("s"), mask_redact(F.col("v")).alias("r"))
    first, second = out.collect()
    assert first["h"] == hashlib.sha256(b"a").hexdigest() and first["s"] == hashlib.sha256(b"sa").hexdigest()
    assert first["r"] == "***REDACTED***" and tuple(second) == (None, None, None)


def test_sums_and_ratios(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "v double")
    row = df.agg(total(F.col("v"), 2).alias("t"), mean(F.col("v"), 2).alias("m"), mean(F.col("v")).alias("plain")).first()
    assert row["t"] == 1.0 and row["m"] == 0.1 and row["plain"] == pytest.approx(0.1)
    empty = df.filter("v IS NULL").agg(total(F.col("v"), 2).alias("t"), mean(F.col("v"), 2).alias("m")).first()
    assert tuple(empty) == (None, None)
    r = spark.range(1).select(ratio(F.lit(1), F.lit(0)).alias("a"), positive_ratio(F.lit(1), F.lit(-1)).alias("b"),
                              ratio(F.lit(1), F.lit(4)).alias("c")).first()
    assert tuple(r) == (None, None, 0.25)


def test_periods_and_calendar(spark):
    assert [parse_period(p) for p in ("P7D", "P90D", "P7Y", "P1Y6M", "P2W")] == [(0, 7), (0, 90), (84, 0), (18, 0), (0, 14)]
    for bad in ("P", "7D", "PT1H"):
        with pytest.raises(ValueError):
            parse_period(bad)
    days = {r["full_date"]: r for r in date_dimension(spark).collect()}
    assert len(days) == 4018
    d = days[dt.date(2021, 1, 3)]
    assert (d["date_key"], d["quarter"], d["month_name"], d["day_of_week"], d["day_name"], d["is_weekend"], d["iso_week"]) == (
        20210103, 1, "January", 7, "Sunday", True, 53)


def test_ticket_words(spark):
    rows = [
        ("please REFUND the lost item", "refund_request", "refund", "negative"),
        ("lost item in car", "lost_item", "inquire", "negative"),
        ("felt unsafe", "safety_incident", "complain", "negative"),
        ("promo code", "promo_question", "inquire", "neutral"),
        ("double charge", "billing_dispute", "complain", "negative"),
        ("driver has cancelled", "driver_complaint", "cancel", "negative"),
        ("cannot log in", "app_issue", "report_bug", "neutral"),
        ("change phone number", "account", "inquire", "neutral"),
        ("hello", "other", "inquire", "neutral"),
    ]
    df = spark.createDataFrame(rows, "t string, c string, i string, s string").withColumn("t", F.lower("t"))
    out = df.select("c", "i", "s", classify(F.col("t"), marts.TICKET_CATEGORY), classify(F.col("t"), marts.TICKET_INTENT),
                    classify(F.col("t"), marts.TICKET_SENTIMENT))
    for r in out.collect():
        assert tuple(r)[:3] == tuple(r)[3:]
    scores = spark.createDataFrame([("urgent",), ("low",), ("odd",), (None,)], "p string").select(
        score_lookup(F.col("p"), marts.PRIORITY_SCORE, marts.DEFAULT_PRIORITY_SCORE))
    assert [round(r[0], 2) for r in scores.collect()] == [0.95, 0.15, 0.4, 0.4]


def test_revenue_with_shared_drivers_and_repeated_trips(spark):
    """Against plain iteration: payouts count once per driver and group, repeated trips fan out."""
    day = dt.datetime(2024, 1, 1)
    charges = spark.createDataFrame([("c1", "t1", 10.0, day), ("c2", "t2", 20.0, day), ("c3", "t3", 5.0, day), ("c4", "t9", 1.0, day)],
                                    "charge_id string, trip_id string, amount double, created_at timestamp")
    trips = spark.createDataFrame([("t1", "LON", "d1"), ("t2", "LON", "d1"), ("t2", "LON", "d2"), ("t3", "LON", None)],
                                  "trip_id string, city_code string, driver_id string")
    drivers = spark.createDataFrame([("d1", "SUV"), ("d2", "SUV")], "driver_id string, vehicle_type string")
    refunds = spark.createDataFrame([("r1", "c2", 1.0), ("r2", "c2", 2.0), ("r3", "c3", 1.0)],
                                    "refund_id string, charge_id string, amount double")
    payouts = spark.createDataFrame([("d1", 7.0), ("d1", 1.0), ("d2", 3.0)], "driver_id string, amount double")
    rows = {r["vehicle_type"]: r for r in marts.revenue_daily(charges, trips, drivers, refunds, payouts).collect()}
    suv, none = rows["SUV"], rows[None]
    assert (suv["gross_revenue_amount"], suv["trip_count"], suv["refund_amount"], suv["refund_count"]) == (50.0, 2, 6.0, 4)
    assert suv["driver_payout_amount"] == 11.0 and suv["platform_commission_amount"] == 12.5
    assert (none["gross_revenue_amount"], none["refund_amount"], none["refund_count"]) == (5.0, 0.0, 0)
    safe = marts.revenue_daily(charges, trips, drivers, refunds, payouts, null_safe=True)
    assert {r["vehicle_type"]: r["refund_amount"] for r in safe.collect()} == {"SUV": 6.0, None: 1.0}


def test_kpis_of_changed_days_use_all_rows(spark):
    trips = spark.createDataFrame(
        [(dt.datetime(2024, 1, d, h), "LON", 10.0 * h, 1.0, 1.0) for d in (1, 2) for h in (1, 2)] + [(None, "LON", 1.0, 1.0, 1.0)],
        "requested_at timestamp, city_code string, fare_amount double, distance_km double, surge_multiplier double")
    out = facts.trip_daily_kpis(trips, trips.filter("requested_at = '2024-01-02 02:00:00'")).collect()
    assert [(r["kpi_date"], r["total_trips"], r["total_revenue"]) for r in out] == [(dt.date(2024, 1, 2), 2, 30.0)]


def test_anomaly_needs_enough_runs(spark):
    runs = spark.createDataFrame([("c", i, 100) for i in range(6)] + [("c", 6, 10), ("c", 7, 100)],
                                 "contract string, start_time int, counts_good int")
    flags = {r["start_time"]: r["anomaly"] for r in slo.row_count_anomaly(runs, policies.ANOMALY).collect()}
    assert [k for k, v in flags.items() if v] == [6]
    few = slo.row_count_anomaly(runs.filter("start_time IN (4, 5, 6)"), policies.ANOMALY)
    assert few.filter("anomaly").count() == 0


def test_row_count_and_quality_policies(spark):
    runs = spark.createDataFrame([(0, 0, "low"), (10, 1, "low"), (10, 1, "critical"), (600_000, 0, None)],
                                 "counts_good int, counts_quarantined int, severity string")
    status = [r["row_count_status"] for r in slo.row_count(runs, policies.ROW_COUNTS["marketplace"]["bronze"]).collect()]
    assert status == ["fail", "ok", "ok", "fail"]
    warn = slo.row_count(runs, slo.RowCountSlo(1, None, warn_only=True)).collect()
    assert [r["row_count_status"] for r in warn] == ["warn", "ok", "ok", "ok"]
    gate = slo.quality_gate(runs, slo.QualitySlo(0.92, 0.10)).collect()
    assert [r["passed"] for r in gate] == [True, True, False, True]


def test_sql_steps_chain(spark):
    step = sql_step("SELECT a + 1 AS a FROM source", "SELECT a * (SELECT max(f) FROM side) AS a FROM source")
    out = step({"source": spark.createDataFrame([(1,), (2,)], "a int"), "side": spark.createDataFrame([(10,)], "f int")})
    assert sorted(r["a"] for r in out.collect()) == [20, 30]


def test_maintenance_on_stored_tables(spark, tables):
    profiles = CONTRACTS["silver_rider_profiles"]
    rows = [(f"r{i}", f"Name {i}", "LON" if i % 2 else "NYC", dt.datetime(2024, 1, 1)) for i in range(10)]
    df = spark.createDataFrame(rows, "rider_id string, name string, city_code string, updated_at timestamp")
    tables.replace(profiles.name, df, ["city_code"])
    tables.replace("gold_shared_dim_driver_360", df.withColumnRenamed("name", "full_name"))
    every = [profiles, CONTRACTS["gold_shared_dim_driver_360"], CONTRACTS["silver_trips"]]
    report = maintenance.erase_subjects(tables, every, "rider_id", ["r1", "r2"], dry_run=True)
    assert [(r["rows_touched"], r["strategy"], r["applied"]) for r in report] == [(2, "nullify", False), (2, "rebuild", False)]
    maintenance.erase_subjects(tables, every, "rider_id", ["r1", "r2"], strategy="redact", partition=("city_code", "LON"))
    names = {r["rider_id"]: r["name"] for r in tables.read(profiles.name).collect()}
    assert names["r1"] == "***REDACTED***" and names["r2"] == "Name 2" and len(names) == 10
    snapshot = spark.createDataFrame([(f"r{i}", dt.datetime(2024, 2, 1)) for i in range(9)], "rider_id string, seen timestamp")
    when = dt.datetime(2024, 2, 1, 5, tzinfo=dt.timezone.utc)
    assert maintenance.reconcile_table(tables, profiles, snapshot, stamp="seen", now=when)["candidates"] == 1
    done = maintenance.reconcile_table(tables, profiles, snapshot, stamp="seen", now=when, dry_run=False)
    assert done["tombstoned"] == 1 and tables.read(profiles.name).filter("is_deleted").first()["rider_id"] == "r9"
    late = maintenance.reconcile_table(tables, profiles, snapshot, stamp="seen", now=when + dt.timedelta(days=3), dry_run=False)
    assert "old" in late["aborted"]
    assert maintenance.apply_retention(tables, profiles, "updated_at", F.lit("2024-04-30").cast("timestamp"))
    assert tables.read(profiles.name).count() == 0
    assert not maintenance.apply_retention(tables, CONTRACTS["silver_stripe_charges"], "created_at", F.lit(None))


def test_reprocess_a_slice(spark, tables):
    c = Contract("t", "silver", "d", fields("k!", "day:date", "v:integer"), primary_key=("k",), strategy="merge")
    old = spark.createDataFrame([("a", "2024-01-01", "1"), ("b", "2024-01-02", "1")], "k string, day string, v string")
    run_contract(spark, c, tables, {"source": old})
    run_contract(spark, c, tables, {"source": old.withColumn("v", F.lit("9"))},
                 reprocess={"column": "day", "start": "2024-01-02", "end": "2024-01-31"})
    assert sorted((r["k"], r["v"]) for r in tables.read("t").collect()) == [("a", 1), ("b", 9)]
