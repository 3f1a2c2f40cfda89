"""Row rules, quarantine, dataset rules, service levels, cost."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contract import Rule
from ..operators import quality, slo
from ..operators.quality import not_null
from . import inputs as I
from .registry import Lake, query

_ORDER_RULES = (
    not_null("o_orderdate"),
    Rule("priority_pattern", "o_orderpriority LIKE '%-%'"),
    Rule("known_status", "o_orderstatus IN ('F', 'O')", "domain"),
    Rule("known_priority", "o_orderpriority IS NULL OR o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')",
         "domain"),
    Rule("price_range", "o_totalprice >= 1000.0 AND o_totalprice <= 450000.0", "range"),
    Rule("price_not_negative", "o_totalprice >= 0"),
)
_LINE_RULES = (
    Rule("shipped_after_start", "l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'", "temporal"),
    Rule("discount_le_tax", "l_discount <= l_tax + 0.05", "cross_field"),
    Rule("quantity_range", "l_quantity BETWEEN 1 AND 45", "range"),
)

_ORDER_FAILS = """
    [x FOR x IN [CASE WHEN NOT coalesce(o_orderdate IS NOT NULL, false) THEN 'not_null:o_orderdate' END,
     CASE WHEN NOT coalesce(o_orderpriority LIKE '%-%', false) THEN 'priority_pattern' END,
     CASE WHEN NOT coalesce(o_orderstatus IN ('F', 'O'), false) THEN 'known_status' END,
     CASE WHEN NOT coalesce(o_orderpriority IS NULL OR o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'), false)
          THEN 'known_priority' END,
     CASE WHEN NOT coalesce(o_totalprice >= 1000.0 AND o_totalprice <= 450000.0, false) THEN 'price_range' END,
     CASE WHEN NOT coalesce(o_totalprice >= 0, false) THEN 'price_not_negative' END] IF x IS NOT NULL]
"""
_LINE_FAILS = """
    [x FOR x IN [CASE WHEN NOT coalesce(l_shipdate >= TIMESTAMP '1996-01-01', false) THEN 'shipped_after_start' END,
     CASE WHEN NOT coalesce(l_discount <= l_tax + CAST(0.05 AS DOUBLE), false) THEN 'discount_le_tax' END,
     CASE WHEN NOT coalesce(l_quantity BETWEEN 1 AND 45, false) THEN 'quantity_range' END] IF x IS NOT NULL]
"""
_CATEGORIES = """
    CASE rule WHEN 'not_null:o_orderdate' THEN 'completeness' WHEN 'known_status' THEN 'domain'
         WHEN 'known_priority' THEN 'domain' WHEN 'price_range' THEN 'range' WHEN 'shipped_after_start' THEN 'temporal'
         WHEN 'discount_le_tax' THEN 'cross_field' WHEN 'quantity_range' THEN 'range' ELSE 'quality' END
"""


def _checked(df, rules):
    return quality.annotate(df, [quality.rule_check(r) for r in rules])


@query("rules_split_good", f"SELECT * FROM orders WHERE len({_ORDER_FAILS}) = 0")
def rules_split_good(lake: Lake):
    return quality.split(_checked(lake("orders"), _ORDER_RULES))[0]


@query("rules_split_quarantine", f"""
    SELECT o_orderkey, o_totalprice, array_to_string(fails, ',') AS failed
    FROM (SELECT *, {_ORDER_FAILS} AS fails FROM orders) WHERE len(fails) > 0
""")
def rules_split_quarantine(lake: Lake):
    bad = quality.split(_checked(lake("orders"), _ORDER_RULES))[1]
    return bad.select("o_orderkey", "o_totalprice", F.concat_ws(",", "_errors.rule").alias("failed"))


@query("rules_split_good_lines", f"""
    SELECT l_orderkey, l_linenumber, l_shipdate, l_extendedprice FROM lineitem WHERE len({_LINE_FAILS}) = 0
""")
def rules_split_good_lines(lake: Lake):
    return quality.split(_checked(lake("lineitem"), _LINE_RULES))[0].select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")


def _quarantine(lake: Lake):
    return {
        "orders": quality.split(_checked(lake("orders"), _ORDER_RULES))[1].withColumnRenamed("o_orderdate", "stamp"),
        "lines": quality.split(_checked(lake("lineitem"), _LINE_RULES))[1].withColumnRenamed("l_shipdate", "stamp"),
    }


@query("quarantine_reasons", f"""
    SELECT entity, rule, {_CATEGORIES} AS category, COUNT(*) AS rejected_rows FROM (
        SELECT 'orders' AS entity, unnest({_ORDER_FAILS}) AS rule FROM orders
        UNION ALL SELECT 'lines', unnest({_LINE_FAILS}) FROM lineitem)
    GROUP BY ALL ORDER BY rejected_rows DESC, entity, rule LIMIT 5
""")
def quarantine_reasons(lake: Lake):
    """The five most frequent reasons over both entities."""
    return quality.quarantine_reasons(_quarantine(lake), top=5)


@query("quarantine_summary", f"""
    SELECT 'orders' AS entity, COUNT(*) AS quarantined_rows, MAX(o_orderdate) AS latest FROM orders
    WHERE len({_ORDER_FAILS}) > 0 AND date_diff('day', o_orderdate, TIMESTAMP '2001-08-01') <= 900
    UNION ALL
    SELECT 'lines', COUNT(*), MAX(l_shipdate) FROM lineitem
    WHERE len({_LINE_FAILS}) > 0 AND date_diff('day', l_shipdate, TIMESTAMP '2001-08-01') <= 900
""")
def quarantine_summary(lake: Lake):
    return quality.quarantine_counts(_quarantine(lake), "stamp", F.lit("2001-08-01").cast("timestamp"), within_days=900)


@query("unique_violations", """
    SELECT l_orderkey, COUNT(*) AS occurrences FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1
""")
def unique_violations(lake: Lake):
    return quality.unique_violations(lake("lineitem"), ["l_orderkey"])


@query("unique_composite", """
    SELECT 'unique:l_orderkey,l_linenumber' AS rule, COUNT(*) AS violating_keys,
           CAST(coalesce(SUM(n - 1), 0) AS BIGINT) AS surplus_rows, COUNT(*) = 0 AS passed
    FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)
""")
def unique_composite(lake: Lake):
    return quality.unique_report(lake("lineitem"), ["l_orderkey", "l_linenumber"])


@query("fk_orphans", """
    SELECT l_orderkey, COUNT(*) AS child_rows FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F') GROUP BY l_orderkey
""")
def fk_orphans(lake: Lake):
    return quality.foreign_key_orphans(
        lake("lineitem"), "l_orderkey", lake("orders").filter("o_orderstatus <> 'F'"), "o_orderkey")


# -- service levels: one run per day and event type or order priority ---------


def _runs(lake: Lake):
    """Each day of an event type is a run of a contract of that name."""
    day = F.date_trunc("day", "ts")
    layer = F.when(F.col("event_type").isin("view", "click"), "bronze").when(
        F.col("event_type") == "purchase", "gold").otherwise("silver")
    severity = F.when(F.col("event_type") == "error", "critical").when(F.col("event_type") == "view", "low")
    return lake("events").groupBy(F.col("event_type").alias("contract"), day.alias("day")).agg(
        F.count_if(F.col("value") <= 100).alias("counts_good"),
        F.count_if(F.col("value") > 100).alias("counts_quarantined"),
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"),
        F.first(layer).alias("data_layer"), F.first(severity).alias("severity"),
    ).withColumn("run_duration_seconds", (F.unix_micros("end_time") - F.unix_micros("start_time")) / 1_000_000.0)


_RUNS_SQL = """
    SELECT event_type AS contract, date_trunc('day', ts) AS day, COUNT(*) FILTER (WHERE value <= 100) AS counts_good,
           COUNT(*) FILTER (WHERE value > 100) AS counts_quarantined, MIN(ts) AS start_time, MAX(ts) AS end_time,
           CASE WHEN event_type IN ('view', 'click') THEN 'bronze' WHEN event_type = 'purchase' THEN 'gold'
                ELSE 'silver' END AS data_layer,
           CASE event_type WHEN 'error' THEN 'critical' WHEN 'view' THEN 'low' END AS severity,
           (epoch_us(MAX(ts)) - epoch_us(MIN(ts))) / 1000000.0 AS run_duration_seconds
    FROM events GROUP BY 1, 2
"""


@query("slo_freshness", """
    SELECT 'events' AS table_name, 'ts' AS check_column, MAX(ts) AS latest,
           CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:30:00') - epoch_us(MAX(ts))) / 60000000.0) AS BIGINT) AS delay_minutes,
           floor((epoch_us(TIMESTAMP '2024-01-31 00:30:00') - epoch_us(MAX(ts))) / 60000000.0) <= 120 AS passed
    FROM events
    UNION ALL
    SELECT 'orders', 'o_orderdate', MAX(o_orderdate),
           CAST(floor((epoch_us(TIMESTAMP '2024-01-31 00:30:00') - epoch_us(MAX(o_orderdate))) / 60000000.0) AS BIGINT), false
    FROM orders
    UNION ALL SELECT 'nation', NULL, NULL, NULL, false
""")
def slo_freshness(lake: Lake):
    candidates = ["updated_at", "ts", "o_orderdate"]
    return slo.freshness(
        {t: (lake(t), candidates) for t in ("events", "orders", "nation")},
        F.lit("2024-01-31 00:30:00").cast("timestamp"), 120)


@query("slo_row_count", f"""
    SELECT contract, day, counts_good, CASE WHEN counts_good BETWEEN 3 AND 60 THEN 'ok' ELSE 'fail' END AS row_count_status
    FROM ({_RUNS_SQL})
""")
def slo_row_count(lake: Lake):
    return slo.row_count(_runs(lake), slo.RowCountSlo(3, 60)).select(
        "contract", "day", "counts_good", "row_count_status")


@query("slo_anomaly", f"""
    SELECT contract, day, counts_good, runs_before, median_before,
           CAST(counts_good AS DOUBLE) / NULLIF(median_before, 0) AS row_ratio,
           runs_before >= 5 AND coalesce(NOT (CAST(counts_good AS DOUBLE) / NULLIF(median_before, 0) BETWEEN 0.8 AND 1.25), false)
               AS anomaly
    FROM (SELECT *, COUNT(*) OVER w AS runs_before, CAST(quantile_cont(counts_good, 0.5) OVER w AS DOUBLE) AS median_before
          FROM ({_RUNS_SQL}) WINDOW w AS (PARTITION BY contract ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
""")
def slo_anomaly(lake: Lake):
    out = slo.row_count_anomaly(_runs(lake), slo.AnomalySlo(min_ratio=0.8, max_ratio=1.25), order=["day"])
    return out.select("contract", "day", "counts_good", "runs_before", "median_before", "row_ratio", "anomaly")


@query("slo_quality", f"""
    SELECT contract, day, g AS good_ratio, q AS quarantine_ratio, need AS required_good_ratio,
           g >= need AND q <= 0.3 AS passed
    FROM (SELECT *, CAST(counts_good AS DOUBLE) / (counts_good + counts_quarantined) AS g,
                 CAST(counts_quarantined AS DOUBLE) / (counts_good + counts_quarantined) AS q,
                 CASE severity WHEN 'critical' THEN 0.999 WHEN 'low' THEN 0.9 ELSE 0.7 END::DOUBLE AS need
          FROM ({_RUNS_SQL}))
""")
def slo_quality(lake: Lake):
    out = slo.quality_gate(_runs(lake), slo.QualitySlo(min_good_ratio=0.7, max_quarantine_ratio=0.3))
    return out.select("contract", "day", "good_ratio", "quarantine_ratio", "required_good_ratio", "passed")


@query("slo_schedule", f"""
    SELECT contract, day, (epoch_us(end_time) - epoch_us(start_time)) / 60000000.0 AS duration_minutes,
           date_trunc('minute', start_time) > planned AS started_late,
           date_trunc('minute', end_time) > planned + INTERVAL 1360 MINUTE AS finished_late,
           run_duration_seconds / 60.0 > 1300 AS over_expected, run_duration_seconds / 60.0 > 1400 AS over_warning
    FROM (SELECT *, date_trunc('day', start_time + INTERVAL 11 HOUR) + INTERVAL 1 HOUR AS planned FROM ({_RUNS_SQL}))
""")
def slo_schedule(lake: Lake):
    out = slo.schedule(_runs(lake), slo.ScheduleSlo("01:00", "23:40", 1300, 1400))
    return out.select("contract", "day", "duration_minutes", "started_late",
                      "finished_late", "over_expected", "over_warning")


@query("run_cost", f"""
    SELECT period, period_start, cost_limit, CAST(SUM(c) AS DOUBLE) AS cost, CAST(SUM(c) AS DOUBLE) > cost_limit AS over_budget
    FROM (
        SELECT start_time, CAST(run_duration_seconds / 3600.0 * CASE data_layer WHEN 'bronze' THEN CAST(0.15 AS DOUBLE) * 1.0
               WHEN 'silver' THEN CAST(0.22 AS DOUBLE) * 5.0 ELSE CAST(0.55 AS DOUBLE) * 12.25 END AS DECIMAL(18,6)) AS c
        FROM ({_RUNS_SQL})
    ), LATERAL (SELECT unnest(['day', 'week', 'month']) AS period, unnest([40.0, 200.0, 600.0])::DOUBLE AS cost_limit,
                       unnest([CAST(start_time AS DATE), CAST(date_trunc('week', start_time) AS DATE),
                               CAST(date_trunc('month', start_time) AS DATE)]) AS period_start)
    GROUP BY 1, 2, 3
""")
def run_cost(lake: Lake):
    return slo.budget_report(slo.run_cost(_runs(lake)), slo.Budget())


@query("cost_anomalies", f"""
    SELECT contract, day, c AS estimated_cost FROM (
        SELECT *, quantile_cont(c, 0.5) OVER (PARTITION BY contract ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS u
        FROM (SELECT *, run_duration_seconds / 3600.0 * CASE data_layer WHEN 'bronze' THEN CAST(0.15 AS DOUBLE) * 1.0
               WHEN 'silver' THEN CAST(0.22 AS DOUBLE) * 5.0 ELSE CAST(0.55 AS DOUBLE) * 12.25 END AS c FROM ({_RUNS_SQL})))
    WHERE c > 1.02 * u
""")
def cost_anomalies(lake: Lake):
    out = slo.cost_anomalies(slo.run_cost(_runs(lake)), slo.Budget(run_multiplier=1.02), order=["day"])
    return out.select("contract", "day", "estimated_cost")


@query("layer_summary", """
    SELECT 'bronze' AS layer, 'events' AS table_name, COUNT(*) AS row_count, 6 AS column_count, MAX(ts) AS latest FROM events
    UNION ALL SELECT 'silver', 'orders', COUNT(*), 6, MAX(o_orderdate) FROM orders
    UNION ALL SELECT 'silver', 'lineitem', COUNT(*), 11, MAX(l_shipdate) FROM lineitem
    UNION ALL SELECT 'gold', 'customer', COUNT(*), 5, NULL FROM customer
    UNION ALL SELECT 'bronze', 'documents', COUNT(*), 5, NULL FROM documents
""")
def layer_summary(lake: Lake):
    plan = {"events": ("bronze", "ts"), "orders": ("silver", "o_orderdate"), "lineitem": ("silver", "l_shipdate"),
            "customer": ("gold", None), "documents": ("bronze", None)}
    return slo.layer_summary({t: (layer, lake(t), stamp) for t, (layer, stamp) in plan.items()})
