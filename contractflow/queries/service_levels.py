"""Contracts run over the given tables into a scratch lake; service levels are read from the run log that this leaves."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..catalog import policies
from ..contract import Contract, Rule, fields
from ..operators.service_levels import evaluate
from ..plans.pipeline import run_contract
from ..session import scratch_path
from ..sinks.runlog import run_log
from ..sinks.tables import Tables
from .registry import Lake, query

_MOMENT = datetime(2024, 1, 31, 4, 10, tzinfo=timezone.utc)

_CONTRACTS = {
    "orders": Contract(
        "silver_orders", "silver", "marketplace",
        fields("o_orderkey:long!", "o_custkey:long!", "o_orderstatus", "o_totalprice:double", "o_orderdate:timestamp", "o_orderpriority"),
        ("o_orderkey",), rules=(
            Rule("price_known", "o_totalprice > 0", severity="critical"), Rule("not_urgent", "o_orderpriority <> '1-URGENT'", severity="low"),
            Rule("settled", "o_orderstatus <> 'P'", severity="medium")),
        change_columns=("o_orderdate",)),
    "events": Contract(
        "bronze_events", "bronze", "payments", fields("event_id:long!", "user_id:long", "ts:timestamp", "event_type", "value:double"),
        rules=(Rule("small", "value <= 100", severity="high"), Rule("no_error", "event_type <> 'error'", severity="critical")),
        change_columns=("updated_at", "ts"), unknown_fields="drop"),
    "customer": Contract(
        "silver_customer", "silver", "reference", fields("c_custkey:long!", "c_mktsegment", "c_acctbal:double"),
        rules=(Rule("in_credit", "c_acctbal >= 0"),), unknown_fields="drop"),
}

_CHECKS = "check IN ('row_count', 'good_ratio', 'quarantine_ratio', 'source_delay', 'minutes_past_start') OR check LIKE 'good_ratio:%'"


@query("slo_run_log", """
    WITH runs(domain, data_layer, contract, total, bad, critical, high, medium, low, newest) AS (
        SELECT 'marketplace', 'silver', 'silver_orders', COUNT(*),
               COUNT(*) FILTER (NOT coalesce(o_totalprice > 0 AND o_orderpriority <> '1-URGENT' AND o_orderstatus <> 'P', false)
                                OR o_orderkey IS NULL OR o_custkey IS NULL),
               COUNT(*) FILTER (NOT coalesce(o_totalprice > 0, false)), COUNT(*) FILTER (o_orderkey IS NULL OR o_custkey IS NULL),
               COUNT(*) FILTER (NOT coalesce(o_orderstatus <> 'P', false)), COUNT(*) FILTER (NOT coalesce(o_orderpriority <> '1-URGENT', false)),
               MAX(CAST(o_orderdate AS TIMESTAMP))
        FROM orders
        UNION ALL
        SELECT 'payments', 'bronze', 'bronze_events', COUNT(*), COUNT(*) FILTER (NOT coalesce(value <= 100 AND event_type <> 'error', false) OR event_id IS NULL),
               COUNT(*) FILTER (NOT coalesce(event_type <> 'error', false)), COUNT(*) FILTER (NOT coalesce(value <= 100, false) OR event_id IS NULL),
               NULL, NULL, MAX(ts)
        FROM events
        UNION ALL
        SELECT 'reference', 'silver', 'silver_customer', COUNT(*), COUNT(*) FILTER (NOT coalesce(c_acctbal >= 0, false) OR c_custkey IS NULL),
               NULL, COUNT(*) FILTER (NOT coalesce(c_acctbal >= 0, false) OR c_custkey IS NULL), NULL, NULL, NULL
        FROM customer
    ), limits(domain, good, bad_most, critical, high, medium, low, rows_least, rows_most, delay, planned) AS (
        VALUES ('marketplace', 0.92, 0.08, 0.999, 0.99, 0.95, 0.9, 10, 500000, 180, 240),
               ('payments', 0.99, 0.01, 0.9999, 0.999, 0.99, 0.95, 1, 200000, 120, 300),
               ('reference', 0.999, 0.001, 1.0, 0.999, NULL, NULL, 1, 100000, NULL, 180)
    ), facts AS (
        SELECT r.domain, data_layer, contract, unnest([
            {'check': 'row_count', 'observed': CAST(total - bad AS DOUBLE), 'least': CAST(rows_least AS DOUBLE), 'most': CAST(rows_most AS DOUBLE)},
            {'check': 'good_ratio', 'observed': (total - bad)::DOUBLE / total, 'least': good::DOUBLE, 'most': NULL},
            {'check': 'quarantine_ratio', 'observed': bad::DOUBLE / total, 'least': NULL, 'most': bad_most::DOUBLE},
            {'check': 'good_ratio:critical', 'observed': 1 - r.critical::DOUBLE / total, 'least': l.critical::DOUBLE, 'most': NULL},
            {'check': 'good_ratio:high', 'observed': 1 - r.high::DOUBLE / total, 'least': l.high::DOUBLE, 'most': NULL},
            {'check': 'good_ratio:medium', 'observed': 1 - r.medium::DOUBLE / total, 'least': l.medium::DOUBLE, 'most': NULL},
            {'check': 'good_ratio:low', 'observed': 1 - r.low::DOUBLE / total, 'least': l.low::DOUBLE, 'most': NULL},
            {'check': 'source_delay', 'observed': (epoch_us(TIMESTAMP '2024-01-31 04:10:00') - epoch_us(newest)) / 60000000.0, 'least': NULL, 'most': delay::DOUBLE},
            {'check': 'minutes_past_start', 'observed': CAST(250 - planned AS DOUBLE), 'least': NULL, 'most': 0.0}]) AS c
        FROM runs r JOIN limits l USING (domain)
    )
    SELECT domain, data_layer, contract, c."check" AS "check", c.observed AS observed, c.least AS least, c.most AS most,
           CASE WHEN coalesce(c.observed >= c.least, true) AND coalesce(c.observed <= c.most, true) THEN 'ok'
                WHEN c."check" = 'minutes_past_start' OR (c."check" = 'row_count' AND domain = 'reference') THEN 'warn' ELSE 'fail' END AS status
    FROM facts WHERE c.observed IS NOT NULL AND (c.least IS NOT NULL OR c.most IS NOT NULL)
""")
def slo_run_log(lake: Lake):
    """Whole tables through real runs; the checks that do not depend on how fast this machine is."""
    tables = Tables(lake.spark, scratch_path(lake.spark, "levels"))
    for name, contract in _CONTRACTS.items():
        run_contract(lake.spark, contract, tables, {"source": lake(name)}, now=_MOMENT, levels=policies.LEVELS)
    checks = evaluate(run_log(tables), policies.LEVELS, F.lit(_MOMENT))
    return checks.where(_CHECKS).drop("run_id")
