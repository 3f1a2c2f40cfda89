"""Schema enforcement, projections, deduplication, masks and text extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contract import Contract, Field, Source, fields
from ..functions.masks import mask_hash, mask_redact
from ..operators import dedup, privacy, schema
from ..operators.quality import annotate, split
from ..session import scratch_path
from ..sources import landing
from ..sources.documents import extract_fields
from ..streaming.events import route
from .registry import Lake, query

_EVENT = Contract("typed_events", "silver", "marketing", fields(
    "event_id:long!", "ts:timestamp!", "user_id:integer", "event_type", "value:float", "k:integer", "props:integer"))


@query("bronze_from_csv", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_acctbal AS VARCHAR) AS c_acctbal, NULL AS c_mktsegment FROM customer
    UNION ALL
    SELECT CAST(c_custkey AS VARCHAR), c_name, NULL, c_mktsegment FROM customer
""")
def bronze_from_csv(lake: Lake):
    """The table as CSV files whose headers differ: another order, another case, a column less, one more than declared."""
    path, rows = scratch_path(lake.spark, "csv"), lake("customer")
    rows.select("c_name", F.col("c_custkey").alias("C_CustKey"), "c_acctbal").write.option("header", True).csv(f"{path}/a")
    rows.select("c_mktsegment", "c_custkey", "c_name").write.option("header", True).csv(f"{path}/b")
    contract = Contract("landed_customers", "bronze", "marketing", fields("c_custkey", "c_name", "c_acctbal"), source=Source("csv", "customers"))
    return landing.read_landing(lake.spark, contract, path).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query("cast_to_string", """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
    FROM orders
""")
def cast_to_string(lake: Lake):
    return schema.to_text(lake("orders").drop("o_totalprice"))


@query("cast_typed_projection", """
    SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, value,
           TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS INTEGER) AS props
    FROM events
""")
def cast_typed_projection(lake: Lake):
    """Events through text and back; JSON text does not fit an integer and becomes NULL."""
    raw = schema.to_text(lake("events")).withColumn("k", F.get_json_object("props", "$.k"))
    typed, _ = schema.conform(raw, _EVENT)
    return schema.drop_helpers(typed)


@query("cast_failures_kept", """
    SELECT event_id, props FROM events WHERE TRY_CAST(props AS INTEGER) IS NULL
""")
def cast_failures_kept(lake: Lake):
    """The raw text of a value that could not be cast stays available."""
    typed, _ = schema.conform(schema.to_text(lake("events")), _EVENT.with_(
        fields=fields("event_id:long", "props:integer"), unknown_fields="drop"))
    return typed.filter(F.col("props").isNull()).select(
        "event_id", F.get_json_object(schema.UNCAST, "$.props").alias("props"))


@query("cast_datetime_formats", """
    SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, o_orderdate AS moment FROM orders
""")
def cast_datetime_formats(lake: Lake):
    """Dates as yyyyMMdd text and timestamps as epoch microseconds held as text."""
    raw = lake("orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        F.unix_micros("o_orderdate").cast("string").alias("moment"))
    c = Contract("dated", "silver", "marketing", (
        Field("id", "long"), Field("day", "date", fmt="yyyyMMdd"), Field("moment", "timestamp", fmt="epoch_micros")))
    return schema.drop_helpers(schema.conform(raw, c)[0])


_STRICT = Contract("purchases", "silver", "payments", (
    Field("event_id", "long", required=True),
    Field("amount", "float", required=True),
    Field("event_type", accepted=("view", "click", "purchase", "signup")),
), unknown_fields="quarantine", evolution="strict")


def _purchases(lake: Lake):
    """Amounts of 50 or less are missing; errors carry an undeclared column."""
    return lake("events").select(
        "event_id", F.when(F.col("value") > 50, F.col("value")).alias("amount"), "event_type",
        F.when(F.col("event_type") == "click", F.col("props")).alias("extra"))


@query("required_and_unknown_fields", """
    SELECT event_id, amount, event_type,
           concat_ws(',', CASE WHEN amount IS NULL THEN 'required:amount' END,
                     CASE WHEN event_type = 'error' THEN 'accepted_values:event_type' END,
                     CASE WHEN event_type = 'click' THEN 'unknown_fields' END) AS failed
    FROM (SELECT event_id, CASE WHEN value > 50 THEN value END AS amount, event_type FROM events)
    WHERE amount IS NULL OR event_type IN ('error', 'click')
""")
def required_and_unknown_fields(lake: Lake):
    typed, checks = schema.conform(_purchases(lake), _STRICT)
    _, bad = split(annotate(typed, checks))
    return bad.select("event_id", "amount", "event_type", F.concat_ws(",", "_errors.rule").alias("failed"))


@query("unknown_fields_drop", """
    SELECT event_id, CASE WHEN value > 50 THEN value END AS amount, event_type FROM events
    WHERE value > 50 AND event_type <> 'error'
""")
def unknown_fields_drop(lake: Lake):
    typed, checks = schema.conform(_purchases(lake), _STRICT.with_(unknown_fields="drop"))
    return split(annotate(typed, checks))[0]


@query("rename_project_drop", """
    SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS note,
           CAST(NULL AS DOUBLE) AS score FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
""")
def rename_project_drop(lake: Lake):
    return (
        lake("orders").filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp"))
        .select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"),
                F.lit(None).cast("string").alias("note"), F.lit(None).cast("double").alias("score"), "o_custkey")
        .drop("o_custkey")
    )


@query("dedup_keys", """
    SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey,
        l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1
""")
def dedup_keys(lake: Lake):
    return dedup.deduplicate(lake("lineitem"), ["l_orderkey"])


@query("dedup_composite", """
    SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey,
        l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1
""")
def dedup_composite(lake: Lake):
    return dedup.deduplicate(lake("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dedup_latest", """
    SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST,
        o_orderkey, o_orderstatus, o_totalprice, o_orderpriority) = 1
""")
def dedup_latest(lake: Lake):
    return dedup.deduplicate_by_latest(lake("orders"), ["o_custkey"], "o_orderdate")


@query("derive_flag", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS sunset_at,
           o_orderstatus <> 'F' AS is_active FROM orders
""")
def derive_flag(lake: Lake):
    closed = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return lake("orders").select("o_orderkey", closed.alias("sunset_at")).withColumn(
        "is_active", F.col("sunset_at").isNull())


@query("mask_hash", """
    SELECT c_custkey, sha256(c_name) AS c_name, sha256('pepper' || CAST(c_nationkey AS VARCHAR)) AS c_nationkey,
           sha256(CASE WHEN c_acctbal > 0 THEN c_mktsegment END) AS c_mktsegment FROM customer
""")
def mask_hash_query(lake: Lake):
    return lake("customer").select(
        "c_custkey", mask_hash(F.col("c_name")).alias("c_name"),
        mask_hash(F.col("c_nationkey"), "pepper").alias("c_nationkey"),
        mask_hash(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))).alias("c_mktsegment"))


@query("mask_redact", """
    SELECT c_custkey, '***REDACTED***' AS c_name,
           CASE WHEN c_acctbal > 0 THEN '***REDACTED***' END AS c_mktsegment FROM customer
""")
def mask_redact_query(lake: Lake):
    return lake("customer").select(
        "c_custkey", mask_redact(F.col("c_name")).alias("c_name"),
        mask_redact(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))).alias("c_mktsegment"))


_PAGE = Contract("page_fields", "bronze", "operations", (
    Field("page_id", "long"),
    Field("title", extract=r"<title>([^<]*)</title>"),
    Field("language", extract=r'<html lang="([a-z-]+)"'),
    Field("charset", extract=r'charset="([^"]+)"'),
    Field("missing", extract=r"Licence No:\s+(\S+)"),
))


@query("extract_fields", r"""
    SELECT page_id, NULLIF(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), '') AS title,
           NULLIF(trim(regexp_extract(html, '<html lang="([a-z-]+)"', 1)), '') AS language,
           NULLIF(trim(regexp_extract(html, 'charset="([^"]+)"', 1)), '') AS charset,
           NULLIF(trim(regexp_extract(html, 'Licence No:\s+(\S+)', 1)), '') AS missing
    FROM pages
""")
def extract_fields_query(lake: Lake):
    return extract_fields(lake("pages"), _PAGE, text="html")


@query("route_json_entity", """
    SELECT body AS json_body, ts AS enqueued_time, coalesce(key, json_extract_string(body, '$._entity')) AS entity,
           strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
    FROM (SELECT ts, CASE WHEN event_type = 'view' THEN 'page_view' END AS key,
                 '{"_entity":"' || event_type || '","id":' || event_id || '}' AS body FROM events)
""")
def route_json_entity(lake: Lake):
    """The batch twin of the event stream."""
    body = F.concat(F.lit('{"_entity":"'), F.col("event_type"), F.lit('","id":'), F.col("event_id"), F.lit("}"))
    return route(lake("events").select(
        body.cast("binary").alias("body"), F.col("ts").alias("enqueuedTime"),
        F.when(F.col("event_type") == "view", "page_view").alias("partitionKey")))


_CUSTOMER = Contract("profiles", "silver", "marketplace", (
    Field("c_custkey", "long", required=True),
    Field("c_name", pii=True, mask="redact"),
    Field("c_mktsegment", pii=True, mask="hash"),
))


@query("mask_by_contract", """
    SELECT c_custkey, '***REDACTED***' AS c_name, sha256('s' || c_mktsegment) AS c_mktsegment FROM customer
""")
def mask_by_contract(lake: Lake):
    typed, _ = schema.conform(lake("customer"), _CUSTOMER)
    return privacy.apply_masks(typed, _CUSTOMER, salt="s")
