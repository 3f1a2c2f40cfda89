from pyspark.sql import functions as F

from contractflow.contract import Rule
from contractflow.operators import dedup, quality


def test_null_is_a_violation_unless_the_rule_allows_it(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "id int, v double")
    rules = [Rule("strict", "v >= 0"), Rule("tolerant", "v IS NULL OR v >= 0")]
    good, bad = quality.split(quality.annotate(df, [quality.rule_check(r) for r in rules]))
    assert [r["id"] for r in good.collect()] == [1]
    assert {r["id"]: [e["rule"] for e in r["_errors"]] for r in bad.collect()} == {2: ["strict"], 3: ["strict", "tolerant"]}


def test_no_rules_and_empty_input(spark):
    df = spark.createDataFrame([], "id int")
    good, bad = quality.split(quality.annotate(df, []))
    assert good.count() == bad.count() == 0
    assert quality.unique_report(df, ["id"]).first()["passed"]


def test_quarantine_reports(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "id int, v string")
    _, bad = quality.split(quality.annotate(df, [quality.rule_check(quality.not_null("v"))]))
    assert quality.quarantine_reasons({"t": bad}).first()["rejected_rows"] == 2
    assert quality.quarantine_sample(bad, "not_null:v", 1).count() == 1
    assert quality.quarantine_sample(bad, "other").count() == 0


def test_dedup_is_deterministic_and_limits_before_the_shuffle(spark):
    rows = [("k", None, 2), ("k", "a", 1), ("k", None, 1), ("m", "z", 9)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, a string, b int").repartition(3)
        out = dedup.deduplicate(df, ["k"])
        assert sorted(map(tuple, out.collect())) == [("k", None, 1), ("m", "z", 9)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_latest_with_null_timestamps_and_ties(spark):
    df = spark.createDataFrame([("k", None, "a"), ("k", 5, "c"), ("k", 5, "b"), ("m", None, "x")], "k string, t int, v string")
    out = dedup.deduplicate_by_latest(df, ["k"], "t")
    assert sorted(map(tuple, out.collect()), key=str) == [("k", 5, "b"), ("m", None, "x")]


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "p int")
    parent = spark.createDataFrame([(2,)], "id int")
    assert [tuple(r) for r in quality.foreign_key_orphans(child, "p", parent, "id").collect()] == [(1, 2)]


def test_rule_pass_is_one_scan(spark):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    checks = [quality.rule_check(Rule(f"r{i}", f"v > {i}")) for i in range(5)]
    plan = quality.annotate(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "Exchange" not in plan


def test_schedule_over_midnight(spark):
    import datetime as dt

    from contractflow.operators import slo

    runs = spark.createDataFrame([(n, dt.datetime.fromisoformat(a), dt.datetime.fromisoformat(b)) for n, a, b in [
        ("late", "2024-01-02 00:10:00", "2024-01-02 00:40:00"), ("early", "2024-01-01 23:40:00", "2024-01-02 00:20:00"),
        ("on time", "2024-01-01 23:50:30", "2024-01-02 01:01:00"), ("next", "2024-01-02 23:51:00", "2024-01-03 00:59:00")]],
        "name string, start_time timestamp, end_time timestamp")
    out = slo.schedule(runs, slo.ScheduleSlo("23:50", "01:00", 60, 90))
    assert {r["name"]: (r["started_late"], r["finished_late"]) for r in out.collect()} == {
        "late": (True, False), "early": (False, False), "on time": (False, True), "next": (True, False)}
    early = slo.schedule(runs.limit(0), slo.ScheduleSlo("00:10", "01:00", 60, 90))
    assert early.count() == 0
    before = spark.createDataFrame([("x", dt.datetime(2024, 1, 1, 23, 55), dt.datetime(2024, 1, 2, 0, 30))], runs.schema)
    (r,) = slo.schedule(before, slo.ScheduleSlo("00:10", "01:00", 60, 90)).collect()
    assert (r["started_late"], r["finished_late"]) == (False, False)


def test_erasure_report_counts_hashed_ids(spark):
    from contractflow.functions.masks import mask_hash
    from contractflow.operators import privacy
    from pyspark.sql import functions as F

    plain = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    hashed = plain.select(mask_hash(F.col("id"), "pepper").alias("id"))
    out = privacy.erasure_report({"plain": plain, "hashed": hashed}, "id", ["a"], {"hashed": ["", "pepper"]})
    assert {r["table_name"]: r["rows_touched"] for r in out.collect()} == {"plain": 2, "hashed": 2}
