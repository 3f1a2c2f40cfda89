import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from contractflow.catalog import CONTRACTS, policies
from contractflow.contract import Contract, Rule, Scd2, fields
from contractflow.operators.service_levels import evaluate
from contractflow.plans.pipeline import run_contract
from contractflow.sinks.runlog import append_run, run_log

NIGHT = datetime(2024, 3, 5, 23, 50, tzinfo=timezone.utc)


def test_a_run_leaves_cost_severities_and_levels(spark, tables):
    c = Contract("silver_x", "silver", "marketplace", fields("id:long!", "price:double", "updated_at:timestamp"), ("id",),
                 rules=(Rule("cheap", "price < 10", severity="low"), Rule("known", "price IS NOT NULL", severity="critical")), system="rideflow")
    rows = spark.createDataFrame([(i, 1.0 if i else 20.0, "2024-03-05 20:00:00" if i else "never") for i in range(20)] + [(None, None, None)],
                                 "id long, price double, updated_at string")
    run_contract(spark, c, tables, {"source": rows}, now=NIGHT, levels=policies.LEVELS, environment="prod")
    (log,) = run_log(tables).collect()
    assert (log["system"], log["environment"], log["cost_currency"]) == ("rideflow", "prod", "GBP")
    assert log["estimated_cost"] == pytest.approx(log["run_duration_seconds"] / 3600 * 1.1)
    assert json.loads(log["report_json"])["bad_by_severity"] == {"high": 1, "low": 2, "critical": 1}
    checks = {x["check"]: x for x in json.loads(log["slo_json"])}
    assert checks["row_count"]["status"] == "ok" and checks["row_count"]["least"] == 10
    assert checks["good_ratio:critical"]["observed"] == pytest.approx(20 / 21) and checks["good_ratio:critical"]["status"] == "fail"
    assert checks["good_ratio:low"]["status"] == "ok"
    assert (checks["source_delay"]["observed"], checks["source_delay"]["status"]) == (230, "fail")
    assert checks["minutes_past_start"]["observed"] == -250  # the planned start at 04:00 of the next day is nearer


def _log(tables, i, good, *, contract="silver_x", seconds=60.0, day=1, status="success", domain="payments", environment="dev"):
    start = datetime(2024, 3, day, 5, 0, tzinfo=timezone.utc) + timedelta(hours=i)
    append_run(tables, run_id=f"r{i}", contract=contract, domain=domain, data_layer="silver", status=status, start_time=start.isoformat(),
               end_time=(start + timedelta(seconds=seconds)).isoformat(), run_duration_seconds=seconds, counts_good=good, counts_quarantined=0,
               environment=environment)


def test_history_of_the_log(spark, tables):
    for i, good in enumerate([100, 100, 100, 100, 100, 20]):
        _log(tables, i, good, seconds=3600.0 if i == 5 else 60.0)
    _log(tables, 6, 1_000, status="failed")
    as_of = F.lit(datetime(2024, 3, 1, 16, 0, tzinfo=timezone.utc))
    rows = evaluate(run_log(tables), policies.LEVELS, as_of).collect()
    found = {(r["check"], r["run_id"]): r for r in rows}
    assert [(r["run_id"], r["status"]) for r in rows if r["check"] == "row_anomaly"] == [("r5", "fail")]  # five runs come before, failed ones do not count
    assert found["row_anomaly", "r5"]["observed"] == 0.2
    assert found["cost_anomaly", "r5"]["status"] == "fail" and found["cost_anomaly", "r4"]["status"] == "ok"
    assert (found["freshness", None]["observed"], found["freshness", None]["status"]) == (300, "fail")
    assert found["cost:day", None]["observed"] == pytest.approx((5 * 60 + 3600 + 60) / 3600 * 1.1, abs=1e-5)
    assert found["duration", "r5"]["status"] == "warn" and found["minutes_past_end", "r5"]["status"] == "fail"


def test_levels_by_layer_domain_and_environment(spark, tables):
    _log(tables, 0, 5, domain="marketplace")
    _log(tables, 1, 0, domain="reference", environment="local")
    _log(tables, 2, None, domain="unknown")
    rows = {(r["run_id"], r["check"]): r for r in evaluate(run_log(tables), policies.LEVELS, F.lit(NIGHT)).collect()}
    assert rows["r0", "row_count"]["status"] == "fail"  # silver of this domain needs ten rows
    assert rows["r1", "row_count"]["status"] == "warn"
    assert ("r1", "minutes_past_start") not in rows and ("r0", "minutes_past_start") in rows
    assert not [k for k in rows if k[0] == "r2"]
    assert evaluate(run_log(tables).limit(0), policies.LEVELS, F.lit(NIGHT)).count() == 0


def test_systems_and_strict_products(spark, tables):
    assert CONTRACTS["silver_checkr_driver_licences"].system == "checkr" and CONTRACTS["gold_fact_payment_reconciliation"].system == "stripe"
    assert {c.evolution for c in CONTRACTS.values() if c.domain == "marketplace" and c.layer == "gold" and c.registered} == {"strict"}
    spec = Scd2("sk", ("a",), timestamp="at")
    c = Contract("gold_d", "gold", "marketplace", fields("k!", "a", "at:timestamp"), ("k",), strategy="scd2", scd2=spec, evolution="strict")
    rows = spark.createDataFrame([("k", "1", datetime(2024, 1, 1))], "k string, a string, at timestamp")
    run_contract(spark, c, tables, {"source": rows})
    with pytest.raises(ValueError, match="strict schema"):
        run_contract(spark, c.with_(fields=fields("k!", "a", "b", "at:timestamp")), tables, {"source": rows.withColumn("b", F.lit("x"))})
