"""Sessions, funnels, completion of requests, range lookup and currencies over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import currency, journeys, ranges
from .registry import Lake, query


@query("session_stitching", """
    WITH marked AS (
        SELECT user_id, ts, event_id, CASE WHEN ts > lag(ts) OVER w + INTERVAL 90 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS begins
        FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    numbered AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM marked)
    SELECT user_id, CAST(session AS BIGINT) AS session, min(ts) AS started, max(ts) AS ended, count(*) AS n_events
    FROM numbered GROUP BY user_id, session
""")
def session_stitching(lake: Lake):
    return journeys.sessions(lake("events"), "user_id", "ts", "event_id", "90 MINUTES")


@query("step_funnel", """
    WITH e AS (SELECT user_id, ts, event_id, event_type FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
    one AS (SELECT user_id, min(struct_pack(ts := ts, id := event_id)) AS p FROM e WHERE event_type = 'view' GROUP BY user_id),
    two AS (SELECT e.user_id, min(struct_pack(ts := e.ts, id := e.event_id)) AS p FROM e JOIN one ON e.user_id = one.user_id
            AND (e.ts > one.p.ts OR (e.ts = one.p.ts AND e.event_id > one.p.id)) WHERE event_type = 'click' GROUP BY e.user_id),
    three AS (SELECT e.user_id, min(struct_pack(ts := e.ts, id := e.event_id)) AS p FROM e JOIN two ON e.user_id = two.user_id
            AND (e.ts > two.p.ts OR (e.ts = two.p.ts AND e.event_id > two.p.id)) WHERE event_type = 'purchase' GROUP BY e.user_id)
    SELECT one.user_id, one.p.ts AS at_1, two.p.ts AS at_2, three.p.ts AS at_3,
        CAST(1 + (two.p IS NOT NULL)::INT + (three.p IS NOT NULL)::INT AS INTEGER) AS reached
    FROM one LEFT JOIN two USING (user_id) LEFT JOIN three USING (user_id)
""")
def step_funnel(lake: Lake):
    return journeys.funnel(lake("events"), "user_id", "ts", "event_id", "event_type", ["view", "click", "purchase"])


_COMPLETIONS_SQL = """
    matched AS (
        SELECT user_id, event_id, event_type, ts AS requested,
            CASE WHEN lead(event_type) OVER w = 'purchase' THEN lead(ts) OVER w END AS completed
        FROM events WHERE event_type IN ('click', 'purchase') AND user_id IS NOT NULL AND ts IS NOT NULL
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    requests AS (
        SELECT user_id, event_id, requested, completed, epoch_us(completed) - epoch_us(requested) AS latency_micros
        FROM matched WHERE event_type = 'click')
"""


@query("request_completion", f"WITH {_COMPLETIONS_SQL} SELECT * FROM requests")
def request_completion(lake: Lake):
    return journeys.completions(lake("events"), "user_id", "ts", "event_id", "event_type", "click", "purchase")


@query("completion_latency", f"""
    WITH {_COMPLETIONS_SQL},
    shifted AS (SELECT CAST(requested AS DATE) AS day, latency_micros AS x, greatest(length(bin(latency_micros)) - 6, 0) AS shift
                FROM requests WHERE latency_micros IS NOT NULL),
    buckets AS (SELECT day, ((x >> shift) << shift) + (CAST(1 AS BIGINT) << shift) - 1 AS bucket, count(*) AS n FROM shifted GROUP BY 1, 2),
    ranked AS (SELECT *, sum(n) OVER (PARTITION BY day ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY day) AS total FROM buckets)
    SELECT day, CAST(max(total) AS BIGINT) AS n, CAST(min(CASE WHEN upto >= ceil(total * 0.5) THEN bucket END) AS BIGINT) AS q50,
        CAST(min(CASE WHEN upto >= ceil(total * 0.9) THEN bucket END) AS BIGINT) AS q90,
        CAST(min(CASE WHEN upto >= ceil(total * 0.99) THEN bucket END) AS BIGINT) AS q99
    FROM ranked GROUP BY day
""")
def completion_latency(lake: Lake):
    """Latency by day of request, from a mergeable sketch."""
    answered = request_completion(lake).withColumn("day", F.to_date("requested"))
    sketch = journeys.quantile_sketch(answered, ["day"], "latency_micros")
    return journeys.sketch_quantiles(sketch, ["day"], [0.5, 0.9, 0.99])


@query("surge_tier_lookup", """
    WITH tiers(tier, low, high) AS (VALUES ('none', NULL, 1.02), ('mild', 1.02, 1.05), ('high', 1.05, 1.09), ('peak', 1.09, NULL)),
    lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_discount + 1 AS surge FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, surge, tier FROM lines LEFT JOIN tiers
      ON (low IS NULL OR surge >= CAST(low AS DOUBLE)) AND (high IS NULL OR surge < CAST(high AS DOUBLE))
""")
def surge_tier_lookup(lake: Lake):
    tiers = lake.spark.createDataFrame(
        [("none", None, 1.02), ("mild", 1.02, 1.05), ("high", 1.05, 1.09), ("peak", 1.09, None)], "tier string, low double, high double")
    lines = lake("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_discount") + 1).alias("surge"))
    return ranges.range_lookup(lines, tiers, "surge", "low", "high", ["tier"])


@query("balance_band_lookup", """
    WITH bands AS (SELECT s_suppkey, s_acctbal AS low, s_acctbal + 10 * (1 + s_nationkey) AS high FROM supplier)
    SELECT c_custkey, c_acctbal, s_suppkey FROM customer LEFT JOIN bands ON c_acctbal >= low AND c_acctbal < high
""")
def balance_band_lookup(lake: Lake):
    """Many ranges that overlap, from the data."""
    bands = lake("supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("low"), (F.col("s_acctbal") + 10 * (1 + F.col("s_nationkey"))).alias("high"))
    return ranges.range_lookup(lake("customer").select("c_custkey", "c_acctbal"), bands, "c_acctbal", "low", "high", ["s_suppkey"])


#: Currencies are named by the digit of a priority; pairs by the days on which an order has them.
_RATES_SQL = """
    quoted AS (
        SELECT CAST(o_orderdate AS DATE) AS date, substr(o_orderpriority, 1, 1) AS base, CAST(1 + o_custkey % 5 AS VARCHAR) AS quote,
            min(1 + o_orderkey % 97 / 50.0) AS rate FROM orders WHERE o_custkey % 7 = 0 GROUP BY 1, 2, 3),
    single AS (
        SELECT date, base, quote, min(struct_pack(how := how, rate := rate)) AS b FROM (
            SELECT date, base, quote, rate, 0 AS how FROM quoted UNION ALL SELECT date, quote, base, 1 / rate, 1 FROM quoted) GROUP BY 1, 2, 3),
    edges AS (SELECT date, base, quote, b.rate AS rate, b.how AS how FROM single),
    every AS (
        SELECT date, base, quote, rate, how, NULL AS between_ FROM edges
        UNION ALL SELECT a.date, a.base, b.quote, a.rate * b.rate, 2, a.quote FROM edges a JOIN edges b
          ON a.date = b.date AND a.quote = b.base WHERE a.base <> b.quote),
    implied AS (
        SELECT *, row_number() OVER (PARTITION BY date, base, quote ORDER BY how, between_ NULLS FIRST, rate) AS place FROM every)
"""


def _rates(lake: Lake):
    orders = lake("orders").where("o_custkey % 7 = 0")
    return currency.implied_rates(orders.select(
        F.to_date("o_orderdate").alias("day"), F.substring("o_orderpriority", 1, 1).alias("from"),
        (1 + F.col("o_custkey") % 5).cast("string").alias("to"), (1 + F.col("o_orderkey") % 97 / F.lit(50.0)).alias("rate")), "day", "from", "to", "rate")


@query("fx_implied_rates", f"""
    WITH {_RATES_SQL} SELECT date, base, quote, rate, CAST(how AS INTEGER) AS how, between_ AS between FROM implied WHERE place = 1
""")
def fx_implied_rates(lake: Lake):
    return _rates(lake)


@query("fx_normalised_amounts", f"""
    WITH {_RATES_SQL},
    dim AS (SELECT date, base, rate, how, lead(date) OVER (PARTITION BY base ORDER BY date) AS until FROM implied WHERE place = 1 AND quote = '3'),
    facts AS (SELECT o_orderkey, o_orderdate, o_totalprice, substr(o_orderpriority, 1, 1) AS cur FROM orders)
    SELECT o_orderkey, o_orderdate, o_totalprice, cur, CASE WHEN cur <> '3' THEN dim.date END AS rate_date,
        CAST(CASE WHEN cur <> '3' THEN how END AS INTEGER) AS rate_how, o_totalprice * CASE WHEN cur = '3' THEN 1.0::DOUBLE ELSE rate END AS o_totalprice_3
    FROM facts LEFT JOIN dim ON cur = base AND o_orderdate >= date AND (until IS NULL OR o_orderdate < until)
      AND o_orderdate < date + INTERVAL 4 DAY
""")
def fx_normalised_amounts(lake: Lake):
    """Order amounts in currency 3 by rates at most three days old."""
    facts = lake("orders").select("o_orderkey", "o_orderdate", "o_totalprice", F.substring("o_orderpriority", 1, 1).alias("cur"))
    return currency.convert(facts, _rates(lake), "o_orderdate", "cur", ["o_totalprice"], "3", max_age_days=3)
