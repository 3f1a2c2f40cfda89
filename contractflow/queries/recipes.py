"""Whole layer recipes on the given tables, and the join and set operators on their own."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contract import Contract, Field, Rule
from ..operators import joins
from ..operators.schema import to_text
from ..plans.pipeline import compile_contract, good_and_bad, stamp
from ..plans.steps import sql_step
from . import inputs as I
from .products import _health, _HEALTH_RULES, _HEALTH_SQL
from ..operators.quality import annotate, rule_check, split
from .registry import Lake, query

_ORDERS = Contract(
    "silver_orders", "silver", "marketplace",
    (
        Field("o_orderkey", "long", required=True), Field("o_custkey", mask="hash", pii=True),
        Field("o_orderstatus", accepted=("F", "O", "P")), Field("o_totalprice", "float"),
        Field("o_orderdate", "timestamp", required=True), Field("o_orderpriority", mask="redact", pii=True),
    ),
    primary_key=("o_orderkey",), dedup_by=("o_orderkey",), latest_by="o_orderdate",
    rules=(Rule("price_range", "o_totalprice BETWEEN 2000 AND 450000", "range"),
           Rule("not_low", "o_orderpriority NOT LIKE '5%'", "pattern")),
)

_DOUBLED_SQL = """
    WITH raw AS (
        SELECT * FROM orders
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, -1.0 AS o_totalprice, o_orderdate - INTERVAL 1 DAY, o_orderpriority
        FROM orders WHERE o_orderstatus = 'F'
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate + INTERVAL 1 DAY, '3-LATER'
        FROM orders WHERE o_orderstatus = 'P'
    ),
    one AS (SELECT * FROM raw WHERE o_totalprice BETWEEN 2000 AND 450000 AND o_orderpriority NOT LIKE '5%'
            QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) = 1),
    unchecked AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC) = 1)
"""


def _raw_orders(lake: Lake):
    """Orders as text, with an older broken copy of some and a newer copy of others."""
    orders = lake("orders")
    older = orders.filter("o_orderstatus = 'F'").withColumns(
        {"o_totalprice": F.lit(-1.0), "o_orderdate": F.col("o_orderdate") - F.make_interval(days=F.lit(1))})
    newer = orders.filter("o_orderstatus = 'P'").withColumns(
        {"o_orderpriority": F.lit("3-LATER"), "o_orderdate": F.col("o_orderdate") + F.make_interval(days=F.lit(1))})
    return to_text(orders.unionByName(older).unionByName(newer))


@query("silver_recipe", _DOUBLED_SQL + """
    SELECT o_orderkey, sha256(CAST(o_custkey AS VARCHAR)) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           '***REDACTED***' AS o_orderpriority
    FROM one
""")
def silver_recipe(lake: Lake):
    """Cast, check, keep the latest good row, split and mask: the good rows."""
    return good_and_bad(_ORDERS, {"source": _raw_orders(lake)})[0]


@query("silver_recipe_dedup_first", _DOUBLED_SQL + """
    SELECT o_orderkey, sha256(CAST(o_custkey AS VARCHAR)) AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           '***REDACTED***' AS o_orderpriority
    FROM unchecked WHERE o_totalprice BETWEEN 2000 AND 450000 AND o_orderpriority NOT LIKE '5%'
""")
def silver_recipe_dedup_first(lake: Lake):
    """The other order: keep the latest row, then check it."""
    return good_and_bad(_ORDERS.with_(dedup_before_rules=True), {"source": _raw_orders(lake)})[0]


@query("silver_recipe_quarantine", _DOUBLED_SQL + """
    SELECT o_orderkey, sha256(CAST(o_custkey AS VARCHAR)) AS o_custkey, '***REDACTED***' AS o_orderpriority,
           concat_ws(',', CASE WHEN o_totalprice NOT BETWEEN 2000 AND 450000 THEN 'price_range:range' END,
                     CASE WHEN o_orderpriority LIKE '5%' THEN 'not_low:pattern' END) AS failed
    FROM raw WHERE o_totalprice NOT BETWEEN 2000 AND 450000 OR o_orderpriority LIKE '5%'
""")
def silver_recipe_quarantine(lake: Lake):
    bad = good_and_bad(_ORDERS, {"source": _raw_orders(lake)})[1]
    failed = F.concat_ws(",", F.transform("_errors", lambda e: F.concat_ws(":", e["rule"], e["category"])))
    return bad.select("o_orderkey", "o_custkey", "o_orderpriority", failed.alias("failed"))


_RAW_EVENTS = Contract(
    "bronze_events", "bronze", "marketing",
    (Field("event_id"), Field("event_type"), Field("user_id"), Field("props")),
    strategy="append", unknown_fields="allow", cast_to_string=True)


@query("bronze_recipe", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, props,
           strftime(ts, '%Y-%m-%d') AS day, 'events' AS _source, TIMESTAMP '2024-02-01' AS _processed_at,
           'run-1' AS _run_id, 'bronze_events' AS _contract_name
    FROM events
""")
def bronze_recipe(lake: Lake):
    """All text, undeclared columns kept, lineage stamped."""
    source = lake("events").select("event_id", "event_type", "user_id", "props", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    good, _ = split(compile_contract(_RAW_EVENTS, {"source": source}))
    return stamp(good, _RAW_EVENTS, "run-1", F.lit("2024-02-01").cast("timestamp"), source=F.lit("events"))


_DAILY = Contract(
    "gold_daily_orders", "gold", "marketplace",
    (Field("day", "date", required=True), Field("status"), Field("orders", "long"), Field("share", "float")),
    primary_key=("day", "status"), unknown_fields="drop",
    transform=sql_step(
        "SELECT to_date(o_orderdate) AS day, o_orderstatus AS status, count(*) AS orders FROM source GROUP BY 1, 2",
        """SELECT s.*, s.orders / CAST(d.orders AS DOUBLE) AS share, 'x' AS dropped FROM source s
           JOIN (SELECT to_date(l_shipdate) AS day, count(*) AS orders FROM shipped GROUP BY 1) d ON s.day = d.day"""),
)


@query("sql_steps", """
    SELECT s.day, status, s.orders, s.orders / CAST(d.orders AS DOUBLE) AS share
    FROM (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status, COUNT(*) AS orders FROM orders GROUP BY 1, 2) s
    JOIN (SELECT CAST(l_shipdate AS DATE) AS day, COUNT(*) AS orders FROM lineitem GROUP BY 1) d ON s.day = d.day
""")
def sql_steps(lake: Lake):
    """SQL text over the source and a link, then enforcement of the declared columns."""
    return good_and_bad(_DAILY, {"source": lake("orders"), "shipped": lake("lineitem")})[0]


@query("marketplace_health_quarantine", _HEALTH_SQL + """
    SELECT kpi_date, city_code, requested_trips, cancelled_trips FROM health WHERE completed_trips > 2 * cancelled_trips
""")
def marketplace_health_quarantine(lake: Lake):
    """Gold rows against a rule that many break."""
    rules = [*_HEALTH_RULES, Rule("cancelled_share", "completed_trips <= 2 * cancelled_trips", "cross_field")]
    return split(annotate(_health(lake), [rule_check(r) for r in rules]))[1].select(
        "kpi_date", "city_code", "requested_trips", "cancelled_trips")


@query("key_spine_joins", """
    WITH a AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS s, COUNT(*) AS orders FROM orders GROUP BY 1, 2),
    b AS (SELECT CAST(l_shipdate AS DATE) AS day, l_linestatus AS s, COUNT(*) AS lines FROM lineitem GROUP BY 1, 2),
    k AS (SELECT day, s FROM a UNION SELECT day, s FROM b)
    SELECT k.day, k.s, orders, lines FROM k LEFT JOIN a ON a.day = k.day AND a.s = k.s
    LEFT JOIN b ON b.day = k.day AND b.s = k.s
""")
def key_spine_joins(lake: Lake):
    a = lake("orders").groupBy(F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("s")).agg(
        F.count(F.lit(1)).alias("orders"))
    b = lake("lineitem").groupBy(F.to_date("l_shipdate").alias("day"), F.col("l_linestatus").alias("s")).agg(
        F.count(F.lit(1)).alias("lines"))
    return joins.join_on_spine([a, b], ["day", "s"])


_NULL_KEYS_SQL = """
    WITH a AS (SELECT CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS f, l_linestatus AS s, COUNT(*) AS n
               FROM lineitem GROUP BY 1, 2),
    b AS (SELECT CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS f, l_linestatus AS s, MAX(l_shipdate) AS last
          FROM lineitem GROUP BY 1, 2)
    SELECT a.f, a.s, n, last FROM a LEFT JOIN b ON
"""


def _null_keyed(lake: Lake):
    lines = lake("lineitem").withColumns({
        "f": F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")), "s": F.col("l_linestatus")})
    return (lines.groupBy("f", "s").agg(F.count(F.lit(1)).alias("n")),
            lines.groupBy("f", "s").agg(F.max("l_shipdate").alias("last")))


@query("left_join_composite", _NULL_KEYS_SQL + " a.f = b.f AND a.s = b.s")
def left_join_composite(lake: Lake):
    """A NULL in a composite key finds nothing."""
    return joins.join_composite(*_null_keyed(lake), ["f", "s"])


@query("left_join_null_safe", _NULL_KEYS_SQL + " a.f IS NOT DISTINCT FROM b.f AND a.s = b.s")
def left_join_null_safe(lake: Lake):
    return joins.join_composite(*_null_keyed(lake), ["f", "s"], null_safe=True)


@query("top_customers", """
    SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM orders
    GROUP BY o_custkey ORDER BY spent DESC, o_custkey LIMIT 50
""")
def top_customers(lake: Lake):
    """Largest first, the top 50 without a global sort."""
    spent = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return lake("orders").groupBy("o_custkey").agg(spent.alias("spent")).orderBy(F.desc("spent"), "o_custkey").limit(50)


@query("distinct_customers_by_day", """
    SELECT CAST(o_orderdate AS DATE) AS day, COUNT(DISTINCT o_custkey) AS customers, COUNT(o_orderkey) AS orders
    FROM orders GROUP BY 1
""")
def distinct_customers_by_day(lake: Lake):
    return lake("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count_distinct("o_custkey").alias("customers"), F.count("o_orderkey").alias("orders"))
