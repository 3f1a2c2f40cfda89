"""Stored tables, merges, the run log, erasure and reconciliation on real files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from contractflow.catalog import CONTRACTS
from contractflow.operators import merge, privacy, reconcile, slo
from contractflow.plans.pipeline import provision, reset_layers, select_contracts
from contractflow.sinks import runlog


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_replace_may_read_what_it_replaces(spark, tables):
    tables.replace("t", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    before = tables.path("t")
    tables.replace("t", tables.read("t").withColumn("v", F.upper("v")))
    assert _rows(tables.read("t")) == [(1, "A"), (2, "B")] and tables.path("t") != before


def test_failed_replace_keeps_the_old_version(spark, tables):
    tables.replace("t", spark.createDataFrame([(1,)], "k int"))
    broken = spark.createDataFrame([(0,)], "k int").select((F.lit(1) / F.col("k")).alias("k"))
    with pytest.raises(Exception):
        tables.replace("t", broken)
    assert _rows(tables.read("t")) == [(1,)]


def test_append_with_a_new_column(spark, tables):
    tables.append("t", spark.createDataFrame([(1,)], "k int"))
    tables.append("t", spark.createDataFrame([(2, "x")], "k int, v string"))
    assert _rows(tables.read("t")) == [(1, None), (2, "x")]


def test_merge_upserts_and_repeats_safely(spark, tables):
    tables.merge("t", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), ["k"])
    batch = spark.createDataFrame([(2, "B"), (2, "B2"), (3, "c")], "k int, v string")
    for _ in range(2):
        tables.merge("t", batch, ["k"])
        assert _rows(tables.read("t")) == [(1, "a"), (2, "B"), (3, "c")]


@pytest.mark.parametrize("parts", [[], ["city"], ["note"]])
def test_a_null_in_the_key_is_replaced_too(spark, tables, parts):
    schema = "day string, city string, note string, n int"
    rows = [("d1", None, "a", 1), ("d1", "LON", "a", 1), ("d2", None, "b", 1)]
    tables.merge("t", spark.createDataFrame(rows, schema), ["day", "city"], parts)
    for _ in range(2):
        tables.merge("t", spark.createDataFrame([("d1", None, "a", 2)], schema), ["day", "city"])
    assert _rows(tables.read("t").select("day", "city", "n")) == [("d1", "LON", 1), ("d1", None, 2), ("d2", None, 1)]


def test_partitioned_merge_rewrites_only_touched_partitions(spark, tables):
    schema = "day string, k int, v string"
    tables.merge("t", spark.createDataFrame([("d1", 1, "a"), ("d2", 1, "b")], schema), ["day", "k"], ["day"])
    folder = tables.path("t")
    untouched = sorted(os.listdir(f"{folder}/day=d1"))
    tables.merge("t", spark.createDataFrame([("d2", 1, "B"), ("d3", 9, "n")], schema), ["day", "k"], ["day"])
    assert tables.path("t") == folder and sorted(os.listdir(f"{folder}/day=d1")) == untouched
    assert _rows(tables.read("t").select("day", "k", "v")) == [("d1", 1, "a"), ("d2", 1, "B"), ("d3", 9, "n")]


def test_a_row_may_change_partition_when_the_key_does_not_hold_it(spark, tables):
    schema = "k int, day string"
    tables.merge("t", spark.createDataFrame([(1, "d0"), (2, "d1")], schema), ["k"], ["day"])
    tables.merge("t", spark.createDataFrame([(1, "d2")], schema), ["k"], ["day"])  # d0 ends up empty
    assert _rows(tables.read("t").select("k", "day")) == [(1, "d2"), (2, "d1")]
    assert not os.path.exists(f"{tables.path('t')}/day=d0")


def test_partitioned_merge_by_other_key_rewrites_old_and_new_partitions(spark, tables):
    schema = "k int, day string, v string"
    rows = [(1, "d1", "a"), (2, "d1", "a"), (3, "d2", "a"), (4, "d3", "a")]
    tables.merge("t", spark.createDataFrame(rows, schema), ["k"], ["day"])
    folder = tables.path("t")
    untouched = sorted(os.listdir(f"{folder}/day=d3"))
    tables.merge("t", spark.createDataFrame([(1, "d2", "moved"), (5, "d4", "new")], schema), ["k"])
    assert tables.path("t") == folder and sorted(os.listdir(f"{folder}/day=d3")) == untouched
    for v in ("null", "null again"):
        tables.merge("t", spark.createDataFrame([(6, None, v), (7, None, "stays")], schema).filter(
            F.col("k") == (6 if v == "null again" else F.col("k"))), ["k"])
    assert tables.path("t") == folder
    assert _rows(tables.read("t").select("k", "day", "v").filter("day IS NULL")) == [
        (6, None, "null again"), (7, None, "stays")]
    assert _rows(tables.read("t").select("k", "day", "v").filter("day IS NOT NULL")) == [
        (1, "d2", "moved"), (2, "d1", "a"), (3, "d2", "a"), (4, "d3", "a"), (5, "d4", "new")]


def test_compaction_clusters_and_keeps_rows(spark, tables):
    tables.replace("t", spark.range(1000).repartition(16).withColumn("g", F.col("id") % 7))
    tables.compact("t", 2, ["g"])
    files = [f for f in os.listdir(tables.path("t")) if f.endswith(".parquet")]
    assert len(files) == 2 and tables.read("t").count() == 1000


def test_reset_reload_and_ddl_only(spark, tables):
    gold = select_contracts(CONTRACTS.values(), layers=["gold"], domains=["marketplace"])
    assert "gold_fact_surge_pricing_inference" not in {c.name for c in gold}
    provision(tables, gold)
    assert tables.read("gold_dim_driver").count() == 0
    assert {"driver_sk", "effective_to", "is_current", "version_number"} <= set(tables.read("gold_dim_driver").columns)
    reset_layers(tables, gold, reload_only=True)
    assert tables.exists("gold_dim_driver")
    reset_layers(tables, gold)
    assert not tables.exists("gold_dim_driver")


def test_run_log_and_watermark(spark, tables):
    assert runlog.high_watermark(spark, tables, "c") is None
    runlog.append_run(tables, contract="c", status="success", max_source_mtime=1706659200.123)
    runlog.append_run(tables, contract="c", status="failed", max_source_mtime=1806659200.0)
    assert runlog.high_watermark(spark, tables, "c") == dt.datetime(2024, 1, 31, 0, 0, 0, 123000, dt.timezone.utc)
    assert len(runlog.run_log(tables).columns) == 31
    with pytest.raises(ValueError):
        runlog.append_run(tables, nonsense=1)


def test_restrict_to_changed_is_one_plan_for_any_number_of_keys(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 10)
    plans = set()
    for n in (2, 10_000):
        changed = spark.createDataFrame([(3 + k,) for k in range(n)], "k long")
        out = merge.restrict_to_changed(df, F.col("g"), changed)
        plans.add("LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString())
        assert out.count() == (20 if n == 2 else 70)
    assert plans == {True}


def test_restrict_to_days_bounds_the_scan(spark, tables):
    days = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * i)) for i in range(80)]
    tables.replace("t", spark.createDataFrame(days, "i int, at timestamp"))
    wanted = spark.createDataFrame([(dt.date(2024, 1, 3),), (dt.date(2024, 1, 5),)], "day date")
    few = merge.restrict_to_days(tables.read("t"), "at", wanted)
    assert sorted(r["i"] for r in few.collect()) == [*range(8, 12), *range(16, 20)]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "Subquery" in plan
    assert merge.restrict_to_days(tables.read("t"), "at", wanted.limit(0)).count() == 0


# -- reconciliation ------------------------------------------------------------


def _active(spark, n):
    return spark.range(n).select(F.col("id").alias("k"), F.lit("2024-01-01").cast("timestamp").alias("updated_at"))


def _now():
    return F.lit("2024-02-01").cast("timestamp")


def test_guards_refuse_bad_snapshots(spark):
    target, snap = _active(spark, 10), spark.range(9).select(F.col("id").alias("k"))

    def run(snapshot, **kw):
        return reconcile.reconcile_guarded(target, snapshot, ["k"], now=_now(), **kw)

    assert "keys" in run(snap.limit(0))[1]["aborted"]
    assert "old" in run(snap, age_hours=30.0)[1]["aborted"]
    assert "would be deleted" in run(snap.filter("k < 7"))[1]["aborted"]
    out, report = run(snap, dry_run=True)
    assert report["candidates"] == 1 and out.filter("is_deleted").count() == 0
    out, report = run(snap, age_hours=1.0)
    assert report["tombstoned"] == 1 and [r["k"] for r in out.filter("is_deleted").collect()] == [9]
    assert out.count() == 10


def test_resurrection_happens_without_any_candidate(spark):
    target = _active(spark, 3)
    first, _ = reconcile.reconcile_guarded(target, spark.createDataFrame([(0,), (1,)], "k long"), ["k"], now=_now(),
                                           guards=reconcile.Guards(max_delete_percent=50))
    again, report = reconcile.reconcile_guarded(first, spark.range(3).withColumnRenamed("id", "k"), ["k"], now=_now())
    assert (report["candidates"], report["resurrected"]) == (0, 1)
    assert again.filter("is_deleted").count() == 0 and again.filter("deleted_at IS NOT NULL").count() == 0


def test_race_guard_spares_new_and_undated_rows(spark):
    rows = [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 3, 1)), (3, None)]
    target = spark.createDataFrame(rows, "k long, updated_at timestamp")
    out = reconcile.reconcile(target, spark.createDataFrame([], "k long"), ["k"], now=_now(), updated="updated_at",
                              snapshot_ts=F.lit("2024-02-01").cast("timestamp"))
    assert [r["k"] for r in out.filter("is_deleted").collect()] == [1]


# -- privacy -------------------------------------------------------------------


def test_erase_by_list_frame_and_long_list(spark):
    df = spark.range(3000).select(F.col("id"), F.lit("x").alias("name"), F.lit(1.0).alias("score"))
    short = privacy.erase(df, "id", [1, 2], ["name", "score"])
    assert short.filter("name IS NULL AND score IS NULL").count() == 2 and short.count() == 3000
    long = privacy.erase(df, "id", list(range(1500)) + [1], ["name"], strategy="redact")
    assert long.filter("name = '***REDACTED***'").count() == 1500 and long.count() == 3000
    limited = privacy.erase(df, "id", [1, 2], ["name"], strategy="hash", salt="s", partition_filter=F.col("id") > 1)
    assert limited.filter("name <> 'x'").count() == 1
    with pytest.raises(ValueError):
        privacy.erase(df, "id", [1], ["name"], strategy="shred")
    assert [privacy.erasure_strategy(d) for d in ("payments", "marketing", "shared", "other")] == [
        "hash", "redact", "rebuild", "nullify"]


def test_release_report(spark):
    df = spark.createDataFrame([(1,)], "effective_from int")
    report = slo.release_report({"a": df, "b": None, "c": df.limit(0)}, {"a": ["effective_from", "is_current"]})
    assert {(r["table_name"], r["assertion"], r["passed"]) for r in report.collect()} == {
        ("a", "exists", True), ("a", "has_rows", True), ("a", "has_columns", False), ("b", "exists", False),
        ("c", "exists", True), ("c", "has_rows", False)}


def test_z_order_lets_a_filter_on_either_column_skip_files(spark, tables):
    rows = [(i * 7919 % 1000, f"k{i * 104729 % 997:04d}", i) for i in range(4000)] + [(None, None, -1)]
    tables.replace("t", spark.createDataFrame(rows, "a int, b string, n int"))

    def files_for(column, value):
        spans = tables.read("t").groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(column).alias("low"), F.max(column).alias("high")).collect()
        return sum(r["low"] is not None and r["low"] <= value <= r["high"] for r in spans), len(spans)

    tables.compact("t", 16, zorder_by=["a", "b"])
    assert sorted(map(repr, tables.read("t").collect())) == sorted(repr(r) for r in spark.createDataFrame(rows, "a int, b string, n int").collect())
    for column, value in (("a", 500), ("b", "k0500")):
        touched, files = files_for(column, value)
        assert files >= 12 and touched <= files / 2
    tables.compact("t", 16, cluster_by=["a", "b"])
    touched, files = files_for("b", "k0500")
    assert touched > files / 2
    with pytest.raises(ValueError):
        tables.compact("t", 16, ["a"], ["b"])


def test_a_batch_of_one_key_rewrites_one_bucket_of_a_type_2_table(spark, tables):
    from contractflow.contract import Contract, Scd2, fields
    from contractflow.plans.pipeline import materialize

    spec = Scd2("sk", track=("a",), timestamp="ts", version="v", buckets=8)
    contract = Contract("dim", "gold", "d", fields("k:long!", "a", "ts:timestamp"), primary_key=("k",), strategy="scd2", scd2=spec)
    whole = contract.with_(name="whole", scd2=Scd2("sk", track=("a",), timestamp="ts", version="v"))

    def batch(*rows):
        df = spark.createDataFrame([(k, a, dt.datetime(2024, 1, d)) for k, a, d in rows], "k long, a string, ts timestamp")
        for c in (contract, whole):
            materialize(c, tables, df)

    def files():
        return {r["f"] for r in tables.read("dim").select(F.col("_metadata.file_path").alias("f")).distinct().collect()}

    batch(*[(k, "x", 1) for k in range(200)])
    before = files()
    batch((5, "y", 2))
    after = files()
    bucket = tables.read("dim").filter("k = 5").first()["_bucket"]
    assert {f.split("_bucket=")[1].split("/")[0] for f in before ^ after} <= {str(bucket), "-1"}
    assert len(before & after) >= 7
    batch((5, "z", 3), (300, "n", 3), (6, "x", 4))
    columns = tables.read("whole").columns
    rows = lambda name: sorted(map(repr, tables.read(name).select(columns).collect()))
    assert rows("dim") == rows("whole") and tables.read("dim").filter("sk = '-1'").count() == 1
    plan = tables.read("dim").filter("is_current")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan
