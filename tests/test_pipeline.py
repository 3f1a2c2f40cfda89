"""Contracts end to end: landing files to gold, edge cases, streams."""

import csv
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from contractflow.catalog import CONTRACTS
from contractflow.functions.masks import mask_hash
from contractflow.operators.scd2 import ORIGIN
from contractflow.plans.maintenance import erase_subjects
from contractflow.plans.pipeline import provision, run_contract, select_contracts
from contractflow.sinks.runlog import run_log, typed_run_log
from contractflow.sources import landing
from contractflow.sources.documents import extract_fields, read_documents
from contractflow.streaming import continuous, events


def _write(root, name, columns, rows, folder="y_2024/m_01/d_02/h_03"):
    path = os.path.join(root, name, folder)
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, f"part-{len(os.listdir(path))}.csv"), "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(columns)
        writer.writerows(rows)


def _trip(i, **changes):
    row = dict(
        trip_id=f"t{i}", rider_id=f"r{i % 5}", driver_id=f"d{i % 3}", trip_type="ride", pickup_lat="1", pickup_lng="2",
        dropoff_lat="3", dropoff_lng="4", city_code="LON", requested_at=f"2024-01-0{1 + i % 3} 10:00:00",
        pickup_at="2024-01-01 10:05:00", dropoff_at="2024-01-01 10:30:00", distance_km="5.5", duration_minutes="25",
        fare_amount="20.00", surge_multiplier="1.2", tip_amount="2", payment_method="card", rider_rating="4.5",
        driver_rating="5", notes="")
    row.update(changes)
    return row


def _trips(root, rows, **kw):
    _write(root, "trip_completed", list(rows[0]), [list(r.values()) for r in rows], **kw)


def test_trip_edge_cases(spark, tables, tmp_path):
    """The eight known kinds of broken trips under the written rules."""
    rows = (
        [_trip(i, fare_amount="-15.50") for i in range(0, 6)]
        + [_trip(i, driver_id=f"r{i % 5}") for i in range(6, 10)]
        + [_trip(i, dropoff_at="2023-12-31 10:00:00") for i in range(10, 15)]
        + [_trip(i, distance_km="650.5") for i in range(15, 20)]
        + [_trip(i, notes="'; DROP TABLE trips; --") for i in range(20, 25)]
        + [_trip(i, surge_multiplier="5.8") for i in range(25, 30)]
        + [_trip(i, city_code="XYZ") for i in range(30, 34)]
        + [_trip(i, trip_id="t6") for i in range(34, 40)]
    )
    root = str(tmp_path / "landing")
    _trips(root, rows)
    raw = run_contract(spark, CONTRACTS["bronze_trip_completed"], tables, landing_root=root)
    assert (raw.good, raw.quarantined) == (36, 4)
    clean = run_contract(spark, CONTRACTS["silver_trips"], tables)
    assert (clean.good, clean.quarantined) == (24, 6)
    trips = tables.read("silver_trips")
    assert trips.filter("trip_id = 't6'").count() == 1
    assert trips.filter("notes LIKE '%DROP TABLE%'").count() == 5
    assert trips.filter("surge_multiplier = 5.8 OR distance_km = 650.5").count() == 10
    bad = tables.read("quarantine_silver_trips")
    assert {e["rule"] for r in bad.collect() for e in r["_errors"]} == {"positive_spend"}
    assert {r["_contract_name"] for r in bad.collect()} == {"silver_trips"}
    reject = tables.read("quarantine_bronze_trip_completed").first()
    assert reject["_errors"][0]["rule"] == "accepted_values:city_code" and reject["_source"].endswith(".csv")
    log = {r["contract"]: r for r in run_log(tables).collect()}["silver_trips"]
    assert (log["counts_source"], log["counts_total"], log["counts_good"], log["counts_quarantined"]) == (36, 30, 24, 6)


def test_bad_copies_never_displace_good_ones(spark, tables):
    """Sixty copies of one id and a broken first one; rows without an id all reach quarantine."""
    rows = [_trip(0, trip_id="t1", fare_amount="-15.50")] + [_trip(i, trip_id="t1") for i in range(1, 61)]
    rows += [_trip(i, trip_id=None) for i in range(3)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in rows[0]))
    result = run_contract(spark, CONTRACTS["silver_trips"], tables, {"source": df})
    assert (result.good, result.quarantined) == (1, 4)
    first = CONTRACTS["silver_trips"].with_(name="silver_first", dedup_before_rules=True)
    assert run_contract(spark, first, tables, {"source": df}).quarantined == 2


def test_incremental_load_takes_each_file_once(spark, tables, tmp_path):
    root, bronze = str(tmp_path / "landing"), CONTRACTS["bronze_trip_completed"]
    _trips(root, [_trip(1), _trip(2)])
    assert run_contract(spark, bronze, tables, landing_root=root).good == 2
    assert run_contract(spark, bronze, tables, landing_root=root).good == 0
    _trips(root, [_trip(3)], folder="y_2024/m_01/d_02/h_04")
    later = dt.datetime.now().timestamp() + 10
    path = os.path.join(root, "trip_completed/y_2024/m_01/d_02/h_04")
    os.utime(os.path.join(path, os.listdir(path)[0]), (later, later))
    assert run_contract(spark, bronze, tables, landing_root=root).good == 1
    assert tables.read("bronze_trip_completed").count() == 3


def test_dry_run_writes_nothing(spark, tables, tmp_path):
    root = str(tmp_path / "landing")
    _trips(root, [_trip(1)])
    result = run_contract(spark, CONTRACTS["bronze_trip_completed"], tables, landing_root=root, dry_run=True)
    assert result.good == 1 and not tables.exists("bronze_trip_completed") and not tables.exists("_run_log")


def _seed(root):
    """A few consistent rows for every landing source."""
    days = ["2024-01-01", "2024-01-02"]
    _trips(root, [_trip(i) for i in range(12)])
    os.makedirs(f"{root}/trip_requests/y_2024/m_01/d_02/h_03", exist_ok=True)
    with open(f"{root}/trip_requests/y_2024/m_01/d_02/h_03/a.json", "w") as f:
        json.dump([dict(request_id=f"q{i}", rider_id=f"r{i % 5}", trip_type="ride", city_code="LON",
                        requested_at=f"2024-01-0{1 + i % 3} 10:00:00", surge_multiplier="1.1") for i in range(15)], f)
    content = {
        "driver_profiles": [dict(driver_id=f"d{i}", name=f"N{i}", email=f"d{i}@x.org", licence_number=f"L{i}",
                                 vehicle_type="SEDAN", city_code="LON", status="active", rating="4.5",
                                 updated_at="2023-12-01 00:00:00") for i in range(3)],
        "driver_telemetry": [dict(telemetry_id="1", driver_id="d1", timestamp="2024-01-01 00:00:00")],
        "rider_app_events": [dict(event_id="1", rider_id="r1", event_name="open", event_timestamp="2024-01-01 00:00:00")],
        "rider_profiles": [dict(rider_id=f"r{i}", email=f"r{i}@x.org" if i else "broken", status="active",
                                updated_at="2023-12-01 00:00:00") for i in range(5)],
        "trip_cancellations": [dict(cancellation_id="c1", trip_id="t1", rider_id="r1", cancelled_by="rider",
                                    city_code="LON", requested_at="2024-01-02 10:00:00", cancelled_at="2024-01-02 10:01:00")],
        "stripe_charges": [dict(charge_id=f"ch{i}", rider_id=f"r{i % 5}", trip_id=f"t{i}", amount="20.00", currency="GBP",
                                status=["succeeded", "failed", "pending"][i % 3], billing_email="a@b.c",
                                created_at=f"2024-01-0{1 + i % 3} 11:00:00") for i in range(12)],
        "stripe_payouts": [dict(payout_id=f"p{i}", driver_id=f"d{i % 3}", amount="50.00", arrival_date=d)
                           for i, d in enumerate(days * 3)],
        "stripe_refunds": [dict(refund_id="rf1", charge_id="ch1", amount="5.00")],
        "google_ads_campaigns": [dict(campaign_id="g1", campaign_name="G", ad_group_id="a", date=d, impressions="100",
                                      clicks="10", cost="7.50", conversions="2", conversion_value="30.00") for d in days],
        "google_analytics_app_events": [dict(event_name="open", event_timestamp="1704067200000000", user_pseudo_id="u")],
        "google_analytics_sessions": [dict(session_id="s", user_pseudo_id="u")],
        "hubspot_email_campaigns": [dict(campaign_id="e1", recipient_email="a@b.c", campaign_name="E",
                                         sent_at="2024-01-01 00:00:00", clicked_at="", bounced="false", unsubscribed="true")],
        "hubspot_push_notifications": [dict(notification_id="n1", platform="ios")],
        "meta_ads_campaigns": [dict(campaign_id="m1", campaign_name="M", date=days[0], impressions="5", clicks="1", spend="3.00")],
        "checkr_background_checks": [dict(report_id=f"k{i}", driver_id=f"d{i}", status="complete",
                                          completed_at="2023-11-01 00:00:00") for i in range(2)],
        "twilio_sms_logs": [dict(message_sid="m", status="sent")],
        "zendesk_support_tickets": [dict(ticket_id="z1", rider_id="r1", driver_id="d1", requester_email="a@b.c",
                                         subject="Refund please", ticket_description="driver was wrong", priority="urgent",
                                         created_at="2024-01-02 00:00:00", satisfaction_rating="good")],
        "city_master": [dict(city_code="LON", city_name="London", timezone="UTC", default_currency="GBP", sunset_at="")],
        "fx_rates_daily": [dict(rate_date=d, base_currency="USD", quote_currency="GBP", rate="0.8") for d in days],
        "dim_cancellation_reason_seed": [dict(reason_code="NO_SHOW", charge_cancellation_fee="true")],
        "dim_country_seed": [dict(country_alpha3="GBR", country_numeric="826")],
        "dim_currency_seed": [dict(currency_code="GBP", minor_units="2")],
        "dim_payment_method_seed": [dict(payment_method_code="CARD", settles_instantly="false")],
        "dim_surge_tier_seed": [dict(surge_tier_code="NONE", multiplier_min="1.0", multiplier_max="1.0")],
        "dim_vehicle_type_seed": [dict(vehicle_type_code="SEDAN", passenger_capacity="4")],
        "dim_date_seed": [dict(date_key="")],
    }
    for name, rows in content.items():
        contract = CONTRACTS.get(f"bronze_{name}") or CONTRACTS[f"gold_{name.removesuffix('_seed')}"]
        columns = contract.field_names
        _write(root, name, columns, [[r.get(c, "") for c in columns] for r in rows])
    os.makedirs(f"{root}/driver_licences", exist_ok=True)
    for i in range(3):
        number = "MISSING" if i == 2 else f"LN-{i}"
        with open(f"{root}/driver_licences/{i}.txt", "w") as f:
            f.write(f"DRIVING LICENCE\nName:  Person {i}\nLicence No: {number}\nDOB: 1990-01-0{i + 1}\nEXP: 2030-01-01\nClasses: B, C\n")


def test_whole_mesh(spark, tables, tmp_path):
    """Every contract, bronze to gold, in the order of the layers and dimensions first."""
    root = str(tmp_path / "landing")
    _seed(root)
    inferences = spark.createDataFrame(
        [("i1", "v1", 3.0, 1.5), ("i2", "v1", 30.0, 1.5), ("i3", "v1", 3.0, 9.0)],
        "inference_id string, model_version string, demand_index double, surge_multiplier double",
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    inferences.write.parquet(f"{root}/surge_inference_landing")
    everything = select_contracts([c.with_(registered=True) for c in CONTRACTS.values()])
    everything.sort(key=lambda c: (["bronze", "silver", "gold"].index(c.layer), c.domain == "shared", c.strategy != "scd2"))
    results = {c.name: run_contract(spark, c, tables, landing_root=root) for c in everything}
    assert len(results) == 66 and {r.status for r in results.values()} == {"success"}
    failed = {n: [k for k, v in r.report.items() if v is False] for n, r in results.items()}
    assert not [n for n, f in failed.items() if f]
    quarantined = {n: r.quarantined for n, r in results.items() if r.quarantined}
    assert quarantined == {"silver_rider_profiles": 1, "gold_fact_surge_pricing_inference": 2}
    # A licence number of MISSING is a text like any other; only an absent one is refused.
    assert tables.read("silver_checkr_driver_licences").count() == 3

    def one(name, condition="true"):
        return tables.read(name).filter(condition).first()

    kpi = one("gold_fact_trip_daily_kpis", "kpi_date = '2024-01-01'")
    assert (kpi["total_trips"], kpi["total_revenue"]) == (4, 80.0)
    card = one("gold_dim_driver_scorecard", "driver_id = 'd1'")
    dim = one("gold_dim_driver", "driver_id = 'd1'")
    assert card["driver_sk"] == dim["driver_sk"] and dim["version_number"] == 1
    # Rider 0 went to quarantine, so its facts belong to the unknown member.
    assert one("gold_fact_rider_daily_metrics", "rider_id = 'r0'")["rider_sk"] == "-1"
    assert one("gold_fact_rider_daily_metrics", "rider_id = 'r1'")["rider_sk"] != "-1"
    ticket = one("gold_fact_ticket_enriched")
    assert (ticket["category"], ticket["intent"], ticket["sentiment"]) == ("refund_request", "refund", "negative")
    assert ticket["urgency_score"] == pytest.approx(0.95) and ticket["rider_sk"] != "-1"
    d360 = one("gold_shared_dim_driver_360", "driver_id = 'd1'")
    assert d360["verification_status"] == "complete" and d360["lifetime_payout_amount"] == 100.0
    assert one("gold_shared_dim_driver_360", "driver_id = 'd2'")["verification_status"] == "unverified"
    health = one("gold_shared_mart_marketplace_health", "kpi_date = '2024-01-02'")
    assert (health["requested_trips"], health["completed_trips"], health["cancelled_trips"]) == (5, 4, 1)
    revenue = one("gold_shared_fact_revenue_daily", "kpi_date = '2024-01-02'")
    assert (revenue["gross_revenue_amount"], revenue["refund_amount"], revenue["trip_count"]) == (80.0, 5.0, 4)
    assert tables.read("gold_shared_mart_acquisition_cost").count() == 4
    assert one("gold_agg_acquisition_roi", "date = '2024-01-01'")["cac"] == 3.75
    assert tables.read("gold_dim_date").count() == 4018
    assert one("gold_dim_city", "city_code = 'LON'")["effective_from"].strftime("%Y-%m-%d") == ORIGIN[:10]
    assert one("gold_fact_fx_rate_daily", "rate_date = '2024-01-02'")["date_key"] == 20240102
    assert one("gold_dim_surge_tier")["multiplier_max"] == 1.0 and one("gold_dim_country")["country_numeric"] == 826
    assert one("silver_google_analytics_app_events")["event_timestamp"] == dt.datetime(2024, 1, 1)
    assert one("silver_zendesk_support_tickets")["satisfaction_rating"] is None
    masked = one("silver_driver_profiles", "driver_id = 'd1'")
    assert masked["name"] == "***REDACTED***" and len(masked["email"]) == 64
    # A second run of the gold layer gives the same tables.
    before = {n: sorted(map(str, tables.read(n).drop("_processed_at", "_run_id").collect())) for n in
              ("gold_dim_driver", "gold_dim_rider", "gold_fact_trip_daily_kpis", "gold_dim_city")}
    for n in before:
        run_contract(spark, CONTRACTS[n], tables)
        again = sorted(map(str, tables.read(n).drop("_processed_at", "_run_id").collect()))
        assert again == before[n]
    assert typed_run_log(run_log(tables)).filter("end_time >= start_time").count() == 70


def test_time_folders(spark, tmp_path):
    root = str(tmp_path)
    for hour in ("03", "04", "05"):
        _trips(root, [_trip(int(hour))], folder=f"y_2024/m_01/d_02/h_{hour}")
    contract = CONTRACTS["bronze_trip_completed"]
    wanted = landing.folder_globs(f"{root}/trip_completed", contract.source.partition_format,
                                  dt.datetime(2024, 1, 2, 4), dt.datetime(2024, 1, 2, 7))
    assert len(wanted) == 4
    df = landing.read_landing(spark, contract, landing.existing(spark, wanted))
    parts = landing.folder_columns(contract.source.partition_format, F.col(landing.SOURCE_FILE))
    assert {tuple(r) for r in df.select(*[c.alias(n) for n, c in parts.items()]).collect()} == {
        (2024, 1, 2, 4), (2024, 1, 2, 5)}
    daily = landing.folder_globs("x", "y_%Y/m_%m/d_%d", dt.datetime(2024, 2, 28, 5), dt.datetime(2024, 3, 1))
    assert daily == ["x/y_2024/m_02/d_28", "x/y_2024/m_02/d_29", "x/y_2024/m_03/d_01"]


def test_documents(spark, tmp_path):
    _seed(str(tmp_path))
    out = extract_fields(read_documents(spark, f"{tmp_path}/driver_licences"), CONTRACTS["bronze_checkr_driver_licences"])
    rows = {r["full_name"]: r for r in out.collect()}
    assert rows["Person 1"]["licence_number"] == "LN-1" and rows["Person 1"]["vehicle_classes"] == "B, C"
    assert rows["Person 0"]["date_of_birth"] == "1990-01-01" and rows["Person 0"]["file_path"].endswith("0.txt")


# -- streams -------------------------------------------------------------------


def _messages(spark, path, first, count):
    spark.range(first, first + count).select(
        F.concat(F.lit('{"_entity":"trips","id":'), F.col("id"), F.lit("}")).cast("binary").alias("body"),
        F.timestamp_seconds(F.lit(1704164645) + F.col("id") * 3600).alias("enqueuedTime"),
        F.when(F.col("id") % 2 == 0, "riders").alias("partitionKey"),
    ).coalesce(1).write.mode("append").parquet(path)


def test_event_landing_is_routed_and_taken_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    _messages(spark, source, 0, 4)
    for expected in (4, 4, 7):
        if expected == 7:
            _messages(spark, source, 4, 3)
        query = events.start_landing(events.read_file_events(spark, source), out, state, available_now=True)
        assert query.awaitTermination(120)
        assert spark.read.json(out).count() == expected
    assert sorted(d for d in os.listdir(out) if "=" in d) == ["entity=riders", "entity=trips"]
    trips = events.landed_messages(spark, out, "trips", "_entity string, id long")
    assert sorted(r["id"] for r in trips.collect()) == [1, 3, 5]
    assert os.path.isdir(f"{out}/entity=trips/year=2024/month=01/day=02/hour=04")


def test_contract_stream_survives_restart_and_redelivery(spark, tables, tmp_path):
    silver = CONTRACTS["silver_trips"]
    source, state = str(tmp_path / "in"), str(tmp_path / "state")
    schema = ", ".join(f"{c} string" for c in silver.field_names)

    def put(rows):
        spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} string" for c in rows[0])).write.mode(
            "append").json(source)

    def run():
        stream = spark.readStream.schema(schema).json(source)
        assert continuous.start_contract_stream(tables, silver, stream, state, available_now=True).awaitTermination(180)

    put([_trip(1), _trip(2)])
    run()
    put([_trip(2, fare_amount="99.0"), _trip(3), _trip(4, fare_amount="-1")])
    run()
    run()
    fares = {r["trip_id"]: r["fare_amount"] for r in tables.read("silver_trips").collect()}
    assert fares == {"t1": 20.0, "t2": 99.0, "t3": 20.0}
    # The same batch once more, as after a crash between write and commit: the run is known and skipped.
    batch = spark.createDataFrame([tuple(_trip(3, fare_amount="5").values())], schema)
    continuous.contract_batches(tables, silver, state)(batch, 1)
    assert tables.read("silver_trips").filter("trip_id = 't3'").first()["fare_amount"] == 20.0
    # Batch 1 of another stream is another run, and none of its rows may be lost.
    continuous.contract_batches(tables, silver, state + "-other")(batch, 1)
    assert tables.read("silver_trips").filter("trip_id = 't3'").first()["fare_amount"] == 5.0
    seen = []
    broken = spark.createDataFrame([("x",)], "unrelated string")
    bad_contract = silver.with_(strategy="nonsense")
    for _ in range(2):
        continuous.contract_batches(tables, bad_contract, state, on_error=lambda e, i: seen.append(i))(broken, 99)
    assert seen == [99, 99]
    assert [r["row"] for r in tables.read("dead_silver_trips").collect()] == ['{"unrelated":"x"}']


def test_columns_of_csv_files_are_bound_by_name(spark, tables, tmp_path):
    bronze = CONTRACTS["bronze_driver_telemetry"]
    root = tmp_path / "landing" / bronze.source.path
    root.mkdir(parents=True)
    (root / "a.csv").write_text("telemetry_id,driver_id,extra\nt1,d1,x\n")
    (root / "b.csv").write_text('driver_id,"Telemetry_ID",speed_kmh\nd2,t2,50\n')
    (root / "c.csv").write_text("driver_id\nd3\n")
    (root / "empty.csv").write_text("")
    run_contract(spark, bronze, tables, landing_root=str(tmp_path / "landing"))
    rows = tables.read(bronze.name).union(tables.read(bronze.name).limit(0)).select("telemetry_id", "driver_id", "speed_kmh", "extra")
    assert sorted(rows.collect(), key=lambda r: r["driver_id"]) == [("t1", "d1", None, "x"), ("t2", "d2", "50", None), (None, "d3", None, None)]


def test_late_files_and_files_of_the_same_time_are_taken(spark, tables, tmp_path):
    bronze = CONTRACTS["bronze_driver_telemetry"]
    root = tmp_path / "landing" / bronze.source.path
    root.mkdir(parents=True)

    def put(name, key, age):
        (root / name).write_text(f"telemetry_id,driver_id\n{key},d1\n")
        os.utime(root / name, (1_700_000_000 - age, 1_700_000_000 - age))

    put("a.csv", "t1", 0)
    run = lambda: run_contract(spark, bronze, tables, landing_root=str(tmp_path / "landing")).good
    assert run() == 1
    put("b.csv", "t2", 0)
    put("c.csv", "t3", 60)
    assert run() == 2 and run() == 0
    assert sorted(r["telemetry_id"] for r in tables.read(bronze.name).collect()) == ["t1", "t2", "t3"]


def test_failed_and_broken_runs_leave_no_rows_twice(spark, tables, monkeypatch):
    contract = CONTRACTS["silver_trips"].with_(strategy="append", unique=())
    schema = ", ".join(f"{c} string" for c in contract.field_names)
    source = {"source": spark.createDataFrame([tuple(_trip(1).values()), tuple(_trip(2, fare_amount="-1").values())], schema)}
    for _ in range(2):
        assert run_contract(spark, contract, tables, source, run_id="r", once=True, fail_on_quarantine=True).status == "failed"
    assert not tables.exists(contract.name) and tables.read(f"quarantine_{contract.name}").count() == 1

    def crash(*_args, **_kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr("contractflow.plans.pipeline.materialize", lambda c, t, good, now: (t.append(c.name, good), crash()))
        with pytest.raises(RuntimeError):
            run_contract(spark, contract, tables, source)
    log = tables.read("_run_log").filter("error_message like 'RuntimeError%'")
    assert log.count() == 1 and tables.read(contract.name).count() == 1
    assert run_contract(spark, contract, tables, source).good == 1
    # one bad row of the refused run and one of the last: what the broken run had stored is gone
    assert tables.read(contract.name).count() == 1 and tables.read(f"quarantine_{contract.name}").count() == 2


def test_text_that_does_not_fit_is_kept_or_quarantined(spark, tables):
    silver = CONTRACTS["silver_trips"]
    schema = ", ".join(f"{c} string" for c in silver.field_names)
    source = {"source": spark.createDataFrame([tuple(_trip(1).values()), tuple(_trip(2, tip_amount="abc").values())], schema)}
    provision(tables, [silver])
    result = run_contract(spark, silver, tables, source)
    assert (result.good, result.report["uncast"]) == (2, 1)
    kept = {r["trip_id"]: (r["tip_amount"], r["_uncast"]) for r in tables.read("silver_trips").collect()}
    assert kept == {"t1": (2.0, None), "t2": (None, '{"tip_amount":"abc"}')}
    result = run_contract(spark, silver, tables, source, fail_on_cast=True)
    assert (result.good, result.quarantined) == (1, 1)
    bad = tables.read("quarantine_silver_trips").first()
    assert "abc" in bad["_uncast"] and "type:tip_amount" in str(bad["_errors"])


def test_erasure_reaches_hashes_and_quarantine(spark, tables):
    requests = next(c for c in CONTRACTS.values() if c.layer == "silver" and "rider_id" in c.field_names and c.field("rider_id").mask == "hash")
    pii = next((c for c in requests.pii_fields if c != "rider_id"), "rider_id")
    stored = spark.createDataFrame([("r1", "x"), ("r2", "y")], f"rider_id string, {pii}_ string").select(
        mask_hash(F.col("rider_id"), "s").alias("rider_id"), *([F.col(f"{pii}_").alias(pii)] if pii != "rider_id" else []))
    tables.replace(requests.name, stored)
    tables.replace(f"quarantine_{requests.name}", stored.withColumn("_uncast", F.lit('{"a":"r1"}')))
    report = erase_subjects(tables, [requests], "rider_id", ["r1"], strategy="nullify", salt="s")
    assert [(r["rows_touched"], r["applied"]) for r in report] == [(1, True), (1, True)]
    assert tables.read(f"quarantine_{requests.name}").filter("_uncast is null").count() == 1


def _appending(spark):
    contract = CONTRACTS["silver_trips"].with_(strategy="append", unique=())
    schema = ", ".join(f"{c} string" for c in contract.field_names)
    return contract, lambda *ids: {"source": spark.createDataFrame([tuple(_trip(i).values()) for i in ids], schema)}


def test_a_run_at_work_is_not_taken_for_a_broken_one(spark, tables, monkeypatch):
    """Two interleaved runs, the second begun and ended between the write and the end of the first, keep all rows."""
    from contractflow.plans import pipeline

    contract, rows = _appending(spark)
    plain = pipeline.materialize

    def slow(c, t, good, now):
        plain(c, t, good, now)
        if not t.read(c.name).filter("trip_id = 't2'").count():
            with monkeypatch.context() as m:
                m.setattr("contractflow.plans.pipeline.materialize", plain)
                assert run_contract(spark, contract, tables, rows(2)).status == "success"

    monkeypatch.setattr("contractflow.plans.pipeline.materialize", slow)
    assert run_contract(spark, contract, tables, rows(1)).status == "success"
    assert sorted(r["trip_id"] for r in tables.read(contract.name).collect()) == ["t1", "t2"]
    assert tables.claims.broken(contract.name) == []


def test_a_run_whose_heart_has_stopped_is_cleaned_up_without_a_rewrite(spark, tables):
    """A driver that died leaves a claim and rows; files of other runs stay as they are. A run in the log is not undone."""
    from contractflow.sinks.claims import Claims

    contract, rows = _appending(spark)
    for run, key in (("kept", 1), ("died", 2), ("logged", 3)):
        run_contract(spark, contract, tables, rows(key), run_id=run)
    log = tables.read("_run_log").filter("run_id <> 'died'").collect()
    tables.replace("_run_log", spark.createDataFrame(log, tables.read("_run_log").schema))
    past = Claims(spark, tables.root, clock=lambda: 0.0)
    for run in ("died", "logged"):
        past._create(past._path(contract.name, run), past._content("live"))
    before = {r["f"] for r in tables.read(contract.name).filter("trip_id <> 't2'").select(F.col("_metadata.file_path").alias("f")).collect()}
    path = tables.path(contract.name)
    assert run_contract(spark, contract, tables, rows(4)).status == "success"
    assert sorted(r["trip_id"] for r in tables.read(contract.name).collect()) == ["t1", "t3", "t4"]
    after = {r["f"] for r in tables.read(contract.name).select(F.col("_metadata.file_path").alias("f")).collect()}
    assert before < after and tables.path(contract.name) == path and tables.claims.broken(contract.name) == []


def test_only_one_of_many_takes_a_claim(spark, tables):
    from concurrent.futures import ThreadPoolExecutor

    claims, inside, most = tables.claims, [], []

    def work(i):
        with claims.held("t", "_writer", wait=60):
            inside.append(i)
            most.append(len(inside))
            inside.remove(i)

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(work, range(12)))
    assert most == [1] * 12
    with claims.held("t", "x"):
        with pytest.raises(RuntimeError), claims.held("t", "x"):
            pass
        assert claims.broken("t") == []
    with pytest.raises(KeyError), claims.held("t", "y"):
        raise KeyError
    assert claims.broken("t") == ["y"]


def test_refused_files_stay_in_their_batch_and_dry_runs_take_none(spark, tables, tmp_path):
    bronze = CONTRACTS["bronze_driver_telemetry"].with_(strategy="append")
    from contractflow.contract import Rule

    strict = bronze.with_(rules=(Rule("driver", "driver_id <> 'bad'"),))
    root = tmp_path / "landing" / bronze.source.path
    root.mkdir(parents=True)
    (root / "a.csv").write_text("telemetry_id,driver_id\nt1,d1\nt2,bad\n")
    run = lambda c, **kw: run_contract(spark, c, tables, landing_root=str(tmp_path / "landing"), **kw)
    assert run(strict, dry_run=True).quarantined == 1 and not tables.exists(bronze.name)
    first = run(strict, fail_on_quarantine=True)
    assert (first.status, first.refused) == ("failed", True) and not tables.exists(bronze.name)
    (root / "b.csv").write_text("driver_id,telemetry_id\nd3,t3\n")
    assert run(bronze, dry_run=True).good == 3
    assert run(bronze).good == 3 and run(bronze).good == 0
    assert sorted(r["telemetry_id"] for r in tables.read(bronze.name).collect()) == ["t1", "t2", "t3"]


def test_a_run_reads_the_time_folders_of_its_window_only(spark, tables, tmp_path):
    root = str(tmp_path / "landing")
    for hour in ("03", "04", "05"):
        _trips(root, [_trip(int(hour))], folder=f"y_2024/m_01/d_02/h_{hour}")
    bronze = CONTRACTS["bronze_trip_completed"]
    window = (dt.datetime(2024, 1, 2, 4), dt.datetime(2024, 1, 2, 5))
    assert run_contract(spark, bronze, tables, landing_root=root, window=window).good == 2
    assert sorted(r["trip_id"] for r in tables.read(bronze.name).collect()) == ["t4", "t5"]
    rows = landing.with_folder_columns(landing.read_window(spark, bronze, f"{root}/trip_completed", *window), bronze)
    assert {(r["_year"], r["_hour"]) for r in rows.collect()} == {(2024, 4), (2024, 5)}
