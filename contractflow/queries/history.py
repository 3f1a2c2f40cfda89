"""Type 2 history, point-in-time joins, merges, reconciliation, erasure, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..contract import Scd2
from ..functions import masks
from ..operators import asof, merge, privacy, reconcile, scd2
from ..session import stage
from . import inputs as I
from .registry import Lake, query

_UNKNOWN_RIDER = """
    UNION ALL SELECT '-1', NULL, NULL, NULL, NULL, NULL, TIMESTAMP '1900-01-01', NULL, true, 1
"""
_RIDER_COLUMNS = ("rider_sk, rider_id, o_orderpriority, o_orderstatus, o_orderkey, o_orderdate, effective_from, "
                  "effective_to, is_current, version_number")


@query("scd2_history", f"WITH {I.RIDER_DIM_SQL} SELECT {_RIDER_COLUMNS} FROM dim {_UNKNOWN_RIDER}")
def scd2_history(lake: Lake):
    return I.rider_dim(lake)


@query("scd2_history_lines", f"WITH {I.DRIVER_DIM_SQL} SELECT driver_sk, driver_id, l_returnflag, l_linestatus, "
       "l_shipdate, effective_from, effective_to, is_current, version_number FROM dim "
       "UNION ALL SELECT '-1', NULL, NULL, NULL, NULL, TIMESTAMP '1900-01-01', NULL, true, 1")
def scd2_history_lines(lake: Lake):
    """Long histories: some hundred changes per key."""
    return I.driver_dim(lake)


@query("scd2_apply", f"WITH {I.RIDER_DIM_SQL} SELECT {_RIDER_COLUMNS} FROM dim {_UNKNOWN_RIDER}")
def scd2_apply(lake: Lake):
    """Two batches applied in turn give the same versions as the whole history."""
    rows = I.rider_history(lake)
    cut = F.lit("1998-01-01").cast("timestamp")
    first = stage(scd2.scd2_history(rows.filter(F.col("o_orderdate") < cut), ["rider_id"], I.RIDER_DIM), "dim")
    return scd2.scd2_apply(first, rows.filter(F.col("o_orderdate") >= cut), ["rider_id"], I.RIDER_DIM)


@query("scd2_reapply", f"WITH {I.RIDER_DIM_SQL} SELECT {_RIDER_COLUMNS} FROM dim {_UNKNOWN_RIDER}")
def scd2_reapply(lake: Lake):
    """Applying rows that are already in the dimension changes nothing."""
    stored = stage(I.rider_dim(lake), "dim")
    return scd2.scd2_apply(stored, I.rider_history(lake), ["rider_id"], I.RIDER_DIM)


_SEGMENT = Scd2("customer_sk", track=("c_mktsegment",))


@query("scd2_unknown_member", """
    SELECT sha256('["' || c_custkey || '","1900-01-01 00:00:00.000000"]') AS customer_sk, c_custkey, c_mktsegment,
           TIMESTAMP '1900-01-01' AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current
    FROM customer
    UNION ALL SELECT '-1', NULL, NULL, TIMESTAMP '1900-01-01', NULL, true
""")
def scd2_unknown_member(lake: Lake):
    """No change timestamp: versions start at the origin sentinel."""
    return scd2.scd2_history(lake("customer").select("c_custkey", "c_mktsegment"), ["c_custkey"], _SEGMENT)


@query("scd2_snapshot_apply", """
    WITH old AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0),
    new AS (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'PREMIUM' ELSE c_mktsegment END AS c_mktsegment FROM customer),
    versions AS (
        SELECT c_custkey, c_mktsegment, TIMESTAMP '1900-01-01' AS effective_from FROM old
        UNION ALL SELECT new.c_custkey, new.c_mktsegment,
               CASE WHEN old.c_custkey IS NULL THEN TIMESTAMP '1900-01-01' ELSE TIMESTAMP '2024-05-01' END
        FROM new LEFT JOIN old USING (c_custkey) WHERE old.c_mktsegment IS DISTINCT FROM new.c_mktsegment
    )
    SELECT sha256('["' || c_custkey || '","' || strftime(effective_from, '%Y-%m-%d %H:%M:%S.%f') || '"]') AS customer_sk,
           c_custkey, c_mktsegment, effective_from,
           lead(effective_from) OVER w AS effective_to, lead(effective_from) OVER w IS NULL AS is_current
    FROM versions WINDOW w AS (PARTITION BY c_custkey ORDER BY effective_from)
    UNION ALL SELECT '-1', NULL, NULL, TIMESTAMP '1900-01-01', NULL, true
""")
def scd2_snapshot_apply(lake: Lake):
    customers = lake("customer")
    first = stage(scd2.scd2_history(
        customers.filter("c_acctbal > 0").select("c_custkey", "c_mktsegment"), ["c_custkey"], _SEGMENT), "dim")
    segment = F.when(F.col("c_acctbal") > 5000, "PREMIUM").otherwise(F.col("c_mktsegment"))
    snapshot = customers.select("c_custkey", segment.alias("c_mktsegment"))
    return scd2.scd2_snapshot_apply(first, snapshot, ["c_custkey"], _SEGMENT, "2024-05-01 00:00:00")


@query("scd2_late_rows", f"""
    WITH {I.RIDER_DIM_SQL}
    SELECT o.o_custkey AS rider_id, o.o_orderkey FROM orders o JOIN dim ON o.o_custkey = dim.rider_id AND is_current
    WHERE o.o_orderdate <= effective_from AND (o.o_orderpriority IS DISTINCT FROM dim.o_orderpriority
          OR o.o_orderstatus IS DISTINCT FROM dim.o_orderstatus)
""")
def scd2_late_rows(lake: Lake):
    return scd2.late_rows(I.rider_dim(lake), I.rider_history(lake), ["rider_id"], I.RIDER_DIM).select(
        "rider_id", "o_orderkey")


@query("scd2_asof_date", f"""
    WITH {I.RIDER_DIM_SQL}, probe AS (SELECT DISTINCT user_id AS rider_id, CAST(ts AS DATE) - 9000 + CAST(user_id AS INTEGER) * 3 AS day FROM events)
    SELECT probe.rider_id, day, coalesce(rider_sk, '-1') AS rider_sk, o_orderpriority FROM probe LEFT JOIN dim
      ON probe.rider_id = dim.rider_id AND day >= CAST(effective_from AS DATE)
     AND (effective_to IS NULL OR day < CAST(effective_to AS DATE))
""")
def scd2_asof_date(lake: Lake):
    day = F.date_add(F.date_sub(F.to_date("ts"), 9000), F.col("user_id").cast("int") * 3)
    probes = lake("events").select(F.col("user_id").alias("rider_id"), day.alias("day")).distinct()
    out = asof.asof_by_day(probes, I.rider_dim(lake), ["rider_id"], "day", ["rider_sk", "o_orderpriority"])
    return out.withColumn("rider_sk", asof.or_unknown(F.col("rider_sk")))


@query("scd2_asof_timestamp", f"""
    WITH {I.DRIVER_DIM_SQL}, probe AS (SELECT event_id, user_id AS driver_id, ts - INTERVAL 9000 DAY AS moment FROM events)
    SELECT event_id, probe.driver_id, moment, coalesce(driver_sk, '-1') AS driver_sk, version_number FROM probe LEFT JOIN dim
      ON probe.driver_id = dim.driver_id AND moment >= effective_from AND (effective_to IS NULL OR moment < effective_to)
""")
def scd2_asof_timestamp(lake: Lake):
    probes = lake("events").select(
        "event_id", F.col("user_id").alias("driver_id"), (F.col("ts") - F.make_interval(days=F.lit(9000))).alias("moment"))
    out = asof.asof_by_time(probes, I.driver_dim(lake), ["driver_id"], "moment", ["driver_sk", "version_number"])
    return out.withColumn("driver_sk", asof.or_unknown(F.col("driver_sk")))


@query("current_version_join", f"""
    WITH {I.RIDER_DIM_SQL}
    SELECT c_custkey AS rider_id, c_name, coalesce(rider_sk, '-1') AS rider_sk
    FROM customer LEFT JOIN dim ON c_custkey = rider_id AND is_current
""")
def current_version_join(lake: Lake):
    current = asof.current_version(I.rider_dim(lake)).select("rider_id", "rider_sk")
    return lake("customer").select(F.col("c_custkey").alias("rider_id"), "c_name").join(
        current, "rider_id", "left").withColumn("rider_sk", asof.or_unknown(F.col("rider_sk")))


# -- merge ----------------------------------------------------------------


def _order_updates(lake: Lake):
    """Price updates of open orders plus orders under new keys, with repeated keys."""
    orders = lake("orders")
    updated = orders.filter("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    added = orders.filter("o_orderstatus = 'P'").withColumn("o_orderkey", -F.col("o_custkey") - 1)
    return updated.unionByName(added)


@query("merge_upsert", """
    WITH src AS (
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderstatus = 'O'
        UNION ALL SELECT -o_custkey - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders WHERE o_orderstatus = 'P'
    ), one AS (
        SELECT * FROM src QUALIFY row_number() OVER (PARTITION BY o_orderkey
            ORDER BY o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority) = 1
    )
    SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM one) UNION ALL SELECT * FROM one
""")
def merge_upsert(lake: Lake):
    return merge.merge_upsert(lake("orders"), _order_updates(lake), ["o_orderkey"])


@query("incremental_recompute", """
    SELECT o_custkey, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spent
    FROM orders GROUP BY o_custkey
""")
def incremental_recompute(lake: Lake):
    """Figures of an old state, with the groups that new rows touch recomputed and upserted."""
    orders = lake("orders")
    cut = F.lit("2001-01-01").cast("timestamp")

    def figures(df):
        spent = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
        return df.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), spent.alias("spent"))

    stored = figures(orders.filter(F.col("o_orderdate") < cut))
    changed = merge.changed_keys(orders.filter(F.col("o_orderdate") >= cut), F.col("o_custkey"), "k")
    fresh = figures(merge.restrict_to_changed(orders, F.col("o_custkey"), changed))
    return merge.merge_upsert(stored, fresh, ["o_custkey"], guard=False)


@query("reprocess_slice", """
    SELECT o_orderkey, o_orderdate, o_orderpriority FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1997-06-30'
      AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def reprocess_slice(lake: Lake):
    out = merge.reprocess_slice(
        lake("orders"), "o_orderdate", start=F.lit("1997-01-01").cast("timestamp"), end=F.lit("1997-06-30").cast("timestamp"))
    return merge.reprocess_slice(out, "o_orderpriority", values=["1-URGENT", "2-HIGH"]).select(
        "o_orderkey", "o_orderdate", "o_orderpriority")


@query("bridge_distinct", """
    SELECT n_name, COUNT(*) AS suppliers, CAST(SUM(lines) AS BIGINT) AS lines FROM (
        SELECT DISTINCT s_nationkey, l_suppkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag = 'R')
    JOIN nation ON n_nationkey = s_nationkey
    LEFT JOIN (SELECT l_suppkey, COUNT(*) AS lines FROM lineitem GROUP BY 1) USING (l_suppkey) GROUP BY n_name
""")
def bridge_distinct(lake: Lake):
    """A distinct key set as the bridge between two aggregates."""
    lines = lake("lineitem")
    sent_back = lines.filter("l_returnflag = 'R'").select("l_suppkey").distinct()
    counts = lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    bridge = sent_back.join(lake("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select("s_nationkey", "l_suppkey")
    return bridge.join(lake("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(counts, "l_suppkey", "left").groupBy(
        "n_name").agg(F.count(F.lit(1)).alias("suppliers"), F.sum("n").alias("lines"))


# -- hard deletes ------------------------------------------------------------

_SNAPSHOT_TIME = "2001-01-01 00:00:00"


def _stored(lake: Lake):
    """Orders as a stored table where a part is flagged already."""
    flagged = F.when(F.col("o_totalprice") > 400000, True)
    return lake("orders").select(
        "o_orderkey", F.col("o_orderdate").alias("updated_at"), flagged.alias("is_deleted"),
        F.when(flagged, F.lit("2000-01-01").cast("timestamp")).alias("deleted_at"),
        F.when(flagged, F.lit("missing_in_snapshot")).alias("delete_reason"))


def _snapshot(lake: Lake):
    """The keys the source still has: all but cheap orders; keys repeat."""
    return lake("lineitem").join(
        lake("orders").filter("o_totalprice > 20000"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select(F.col("l_orderkey").alias("o_orderkey"))


_STORED_SQL = """
    stored AS (SELECT o_orderkey, o_orderdate AS updated_at, o_totalprice > 400000 AS del FROM orders),
    snap AS (SELECT DISTINCT l_orderkey AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_totalprice > 20000),
    state AS (SELECT stored.*, k IS NOT NULL AS present FROM stored LEFT JOIN snap ON k = o_orderkey)
"""


def _reconciled(lake: Lake, **options):
    return reconcile.reconcile(_stored(lake), _snapshot(lake), ["o_orderkey"],
                               now=F.lit("2001-02-01").cast("timestamp"), **options)


@query("reconcile_tombstones", f"""
    WITH {_STORED_SQL}
    SELECT o_orderkey, updated_at,
           CASE WHEN NOT del AND NOT present THEN true WHEN del AND present THEN false WHEN del THEN true END AS is_deleted,
           CASE WHEN NOT del AND NOT present THEN TIMESTAMP '2001-02-01' WHEN del AND present THEN NULL
                WHEN del THEN TIMESTAMP '2000-01-01' END AS deleted_at,
           CASE WHEN NOT del AND NOT present THEN 'missing_in_snapshot' WHEN del AND present THEN NULL
                WHEN del THEN 'missing_in_snapshot' END AS delete_reason
    FROM state
""")
def reconcile_tombstones(lake: Lake):
    return _reconciled(lake)


@query("reconcile_resurrected", f"WITH {_STORED_SQL} SELECT o_orderkey FROM state WHERE del AND present")
def reconcile_resurrected(lake: Lake):
    """Keys that were flagged and are back."""
    before = _stored(lake).filter("is_deleted").select("o_orderkey")
    return _reconciled(lake).filter("NOT is_deleted").select("o_orderkey").join(before, "o_orderkey", "left_semi")


@query("reconcile_race_guard", f"""
    WITH {_STORED_SQL}
    SELECT COUNT(*) FILTER (WHERE NOT del) AS active, (SELECT COUNT(*) FROM snap) AS snapshot_keys,
           COUNT(*) FILTER (WHERE NOT del AND NOT present AND updated_at <= TIMESTAMP '{_SNAPSHOT_TIME}') AS candidates,
           COUNT(*) FILTER (WHERE del AND present) AS returned
    FROM state
""")
def reconcile_race_guard(lake: Lake):
    """Counts for the guards; rows newer than the snapshot are no candidates."""
    return reconcile.reconcile_counts(
        _stored(lake), _snapshot(lake), ["o_orderkey"], updated="updated_at",
        snapshot_ts=F.lit(_SNAPSHOT_TIME).cast("timestamp"))


@query("snapshot_time", "SELECT MAX(o_orderdate) AS snapshot_ts FROM orders")
def snapshot_time(lake: Lake):
    return reconcile.snapshot_time(lake("orders"), "o_orderdate")


# -- erasure and retention -------------------------------------------------------

_SUBJECTS_SQL = "c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)"


def _subjects(lake: Lake):
    return lake("nation").filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))


def _erase(lake: Lake, strategy: str, **options):
    return privacy.erase(lake("customer"), "c_nationkey", _subjects(lake), ["c_name", "c_mktsegment", "c_acctbal"],
                         strategy=strategy, **options)


@query("erase_nullify", f"""
    SELECT c_custkey, c_nationkey, CASE WHEN NOT hit THEN c_name END AS c_name,
           CASE WHEN NOT hit THEN c_acctbal END AS c_acctbal, CASE WHEN NOT hit THEN c_mktsegment END AS c_mktsegment
    FROM (SELECT *, {_SUBJECTS_SQL} AS hit FROM customer)
""")
def erase_nullify(lake: Lake):
    return _erase(lake, "nullify")


@query("erase_hash", f"""
    SELECT c_custkey, c_nationkey, CASE WHEN hit THEN sha256('salt' || c_name) ELSE c_name END AS c_name,
           CASE WHEN NOT hit THEN c_acctbal END AS c_acctbal,
           CASE WHEN hit THEN sha256('salt' || c_mktsegment) ELSE c_mktsegment END AS c_mktsegment
    FROM (SELECT *, {_SUBJECTS_SQL} AS hit FROM customer)
""")
def erase_hash(lake: Lake):
    return _erase(lake, "hash", salt="salt")


@query("erase_redact", f"""
    SELECT c_custkey, c_nationkey, CASE WHEN hit THEN '***REDACTED***' ELSE c_name END AS c_name,
           CASE WHEN NOT hit THEN c_acctbal END AS c_acctbal,
           CASE WHEN hit THEN '***REDACTED***' ELSE c_mktsegment END AS c_mktsegment
    FROM (SELECT *, {_SUBJECTS_SQL} AND c_acctbal < 5000 AS hit FROM customer)
""")
def erase_redact(lake: Lake):
    """Limited to one partition of the table (here: a balance band)."""
    return _erase(lake, "redact", partition_filter=F.col("c_acctbal") < 5000)


@query("erase_hashed_ids", f"""
    SELECT sha256('old' || c_custkey) AS c_custkey, CASE WHEN c_nationkey <> 1 THEN c_name END AS c_name FROM customer
""")
def erase_hashed_ids(lake: Lake):
    """The stored ids are hashes under an earlier salt; the subjects are named by their plain ids."""
    stored = lake("customer").select(masks.mask_hash(F.col("c_custkey"), "old").alias("c_custkey"), "c_name")
    subjects = lake("customer").filter("c_nationkey = 1").select("c_custkey")
    return privacy.erase(stored, "c_custkey", subjects, ["c_name"], salts=["", "new", "old"])


@query("erasure_report", f"""
    SELECT 'customer' AS table_name, COUNT(*) FILTER (WHERE {_SUBJECTS_SQL}) AS rows_touched FROM customer
    UNION ALL SELECT 'supplier', COUNT(*) FILTER (WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1))
    FROM supplier
""")
def erasure_report(lake: Lake):
    tables = {"customer": lake("customer"), "orders": lake("orders"),
              "supplier": lake("supplier").withColumnRenamed("s_nationkey", "c_nationkey")}
    return privacy.erasure_report(tables, "c_nationkey", _subjects(lake))


@query("retention_filter", """
    SELECT event_id, ts FROM events WHERE NOT (ts < TIMESTAMP '2024-01-31' - INTERVAL 7 DAY)
""")
def retention_filter(lake: Lake):
    return privacy.retain(lake("events").select("event_id", "ts"), "ts", privacy.LAYER_RETENTION["bronze"],
                          F.lit("2024-01-31").cast("timestamp"))


@query("retention_years", """
    SELECT o_orderkey, o_orderdate FROM orders WHERE NOT (o_orderdate < TIMESTAMP '2003-06-15' - INTERVAL 7 YEAR)
""")
def retention_years(lake: Lake):
    return privacy.retain(lake("orders").select("o_orderkey", "o_orderdate"), "o_orderdate",
                          privacy.LAYER_RETENTION["gold"], F.lit("2003-06-15").cast("timestamp"))
