"""The given tables seen as the inputs of the products, and the same views in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import deduplicate
from ..operators.scd2 import scd2_history
from ..contract import Scd2
from .registry import Lake

AMOUNT_SCALE = 2  # amounts in the given tables have two decimals


def order_trips(lake: Lake) -> DataFrame:
    """Orders as trips of a rider; the priority digit stands for the rating."""
    return lake("orders").select(
        F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("rider_id"),
        F.col("o_orderdate").alias("requested_at"), F.col("o_totalprice").alias("fare_amount"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("tip_amount"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("rider_rating"),
    )


ORDER_TRIPS_SQL = """
    SELECT o_orderkey AS trip_id, o_custkey AS rider_id, o_orderdate AS requested_at, o_totalprice AS fare_amount,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS tip_amount,
           CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS rider_rating
    FROM orders
"""


def line_trips(lake: Lake) -> DataFrame:
    """Order lines as trips of a driver (supplier) in the city (nation) of the supplier."""
    city = lake("supplier").join(
        lake("nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", F.col("n_name").alias("city_code"))
    return lake("lineitem").join(city, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("trip_id"), F.col("l_suppkey").alias("driver_id"),
        F.col("l_partkey").alias("rider_id"), "city_code",
        F.col("l_shipdate").alias("requested_at"), F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_quantity").alias("distance_km"), (F.col("l_discount") + 1).alias("surge_multiplier"),
        (F.col("l_tax") * 100).alias("driver_rating"), F.col("l_linenumber").alias("duration_minutes"),
        F.col("l_linestatus").alias("line_status"), F.col("l_returnflag").alias("return_flag"),
    )


LINE_TRIPS_SQL = """
    SELECT l_orderkey AS trip_id, l_suppkey AS driver_id, l_partkey AS rider_id, n_name AS city_code,
           l_shipdate AS requested_at, l_extendedprice AS fare_amount, l_quantity AS distance_km,
           l_discount + 1 AS surge_multiplier, l_tax * 100 AS driver_rating, l_linenumber AS duration_minutes,
           l_linestatus AS line_status, l_returnflag AS return_flag
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
"""


RIDER_DIM = Scd2("rider_sk", track=("o_orderpriority", "o_orderstatus"), timestamp="o_orderdate",
                 version="version_number")


def rider_history(lake: Lake) -> DataFrame:
    """A customer's orders as the change history of a rider profile."""
    return lake("orders").select(
        F.col("o_custkey").alias("rider_id"), "o_orderpriority", "o_orderstatus", "o_orderdate", "o_orderkey")


def rider_dim(lake: Lake) -> DataFrame:
    return scd2_history(rider_history(lake), ["rider_id"], RIDER_DIM)


def scd2_sql(source: str, key: str, ts: str, track: list[str], rest: list[str], sk: str) -> str:
    """Common table expressions that end in ``dim``: the versions of a change history."""
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    same = " AND ".join(f"{c} IS NOT DISTINCT FROM lag({c}) OVER w" for c in track)
    columns = ", ".join([key, *[c for c in rest if c != ts], ts])
    return f"""
    one_per_instant AS (
        SELECT {columns} FROM {source} WHERE {key} IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY {key}, {ts} ORDER BY {order}) = 1
    ),
    cuts AS (
        SELECT *, CASE WHEN row_number() OVER w = 1 THEN true ELSE NOT ({same}) END AS is_cut
        FROM one_per_instant WINDOW w AS (PARTITION BY {key} ORDER BY {ts})
    ),
    dim AS (
        SELECT sha256('["' || {key} || '","' || strftime({ts}, '%Y-%m-%d %H:%M:%S.%f') || '"]') AS {sk},
               {columns}, {ts} AS effective_from,
               lead({ts}) OVER v AS effective_to, lead({ts}) OVER v IS NULL AS is_current,
               row_number() OVER v AS version_number
        FROM cuts WHERE is_cut WINDOW v AS (PARTITION BY {key} ORDER BY {ts})
    )"""


RIDER_DIM_SQL = scd2_sql(
    "(SELECT o_custkey AS rider_id, o_orderpriority, o_orderstatus, o_orderdate, o_orderkey FROM orders)",
    "rider_id", "o_orderdate", ["o_orderpriority", "o_orderstatus"],
    ["o_orderpriority", "o_orderstatus", "o_orderdate", "o_orderkey"], "rider_sk",
)


DRIVER_DIM = Scd2("driver_sk", track=("l_returnflag", "l_linestatus"), timestamp="l_shipdate",
                  version="version_number")


def driver_history(lake: Lake) -> DataFrame:
    """A supplier's order lines as the change history of a driver profile."""
    return lake("lineitem").select(
        F.col("l_suppkey").alias("driver_id"), "l_returnflag", "l_linestatus", "l_shipdate")


def driver_dim(lake: Lake) -> DataFrame:
    return scd2_history(driver_history(lake), ["driver_id"], DRIVER_DIM)


DRIVER_DIM_SQL = scd2_sql(
    "(SELECT l_suppkey AS driver_id, l_returnflag, l_linestatus, l_shipdate FROM lineitem)",
    "driver_id", "l_shipdate", ["l_returnflag", "l_linestatus"],
    ["l_returnflag", "l_linestatus", "l_shipdate"], "driver_sk",
)


def charges(lake: Lake) -> DataFrame:
    """Orders as charges; the priority stands for the currency."""
    status = (
        F.when(F.col("o_orderstatus") == "F", "succeeded")
        .when(F.col("o_orderstatus") == "P", "failed").otherwise("pending")
    )
    return lake("orders").select(
        F.col("o_orderkey").alias("charge_id"), F.col("o_orderkey").alias("trip_id"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("currency"),
        status.alias("status"), F.col("o_orderdate").alias("created_at"),
    )


CHARGES_SQL = """
    SELECT o_orderkey AS charge_id, o_orderkey AS trip_id, o_totalprice AS amount, o_orderpriority AS currency,
           CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'P' THEN 'failed' ELSE 'pending' END AS status,
           o_orderdate AS created_at
    FROM orders
"""


def ordered_trips(lake: Lake) -> DataFrame:
    """One trip per order: the city of the customer, the part of one line as the driver."""
    city = lake("customer").join(
        lake("nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("city_code"))
    line = deduplicate(lake("lineitem").select("l_orderkey", "l_partkey"), ["l_orderkey"])
    return lake("orders").select("o_orderkey", "o_custkey").join(city, "o_custkey").join(
        line, F.col("o_orderkey") == F.col("l_orderkey")
    ).select(F.col("o_orderkey").alias("trip_id"), "city_code", F.col("l_partkey").alias("driver_id"))


ORDERED_TRIPS_SQL = """
    SELECT o_orderkey AS trip_id, n_name AS city_code, min(l_partkey) AS driver_id
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey, n_name
"""
