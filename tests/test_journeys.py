"""Sessions, funnels, completions, ranges and currencies against plain Python, with a hot user over many segments."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from contractflow.operators import currency, journeys, ranges

BASE = dt.datetime(2024, 1, 1)
SCHEMA = "user int, ts timestamp, id int, kind string"


@pytest.fixture()
def many_segments(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def some_events(seed, n=600, hot=0.6):
    rng = random.Random(seed)
    rows = [(0 if rng.random() < hot else rng.randrange(1, 30), BASE + dt.timedelta(minutes=rng.randrange(9000)), i,
             rng.choice(["view", "click", "buy"])) for i in range(n)]
    return rows + [(None, BASE, n, "view"), (3, None, n + 1, "click"), (4, BASE, n + 2, "view"), (4, BASE, n + 3, "click"), (4, BASE, n + 4, "buy")]


def by_user(rows):
    out = {}
    for r in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: (r[0], r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_sessions(spark, many_segments, seed):
    rows = some_events(seed)
    want = set()
    for user, own in by_user(rows).items():
        runs = [[own[0]]]
        for a, b in zip(own, own[1:]):
            if b[1] - a[1] > dt.timedelta(minutes=30):
                runs.append([])
            runs[-1].append(b)
        want |= {(user, k, r[0][1], r[-1][1], len(r)) for k, r in enumerate(runs, start=1)}
    out = journeys.sessions(spark.createDataFrame(rows, SCHEMA), "user", "ts", "id", "30 MINUTES").collect()
    assert {tuple(r) for r in out} == want and len(out) == len(want)
    assert journeys.sessions(spark.createDataFrame([], SCHEMA), "user", "ts", "id", "30 MINUTES").count() == 0


def test_one_session_over_all_segments(spark, many_segments):
    rows = [(7, BASE + dt.timedelta(seconds=i), i, "view") for i in range(500)]
    (r,) = journeys.sessions(spark.createDataFrame(rows, SCHEMA), "user", "ts", "id", "5 SECONDS").collect()
    assert (r["session"], r["n_events"], r["ended"]) == (1, 500, rows[-1][1])


def test_funnel(spark):
    rows = some_events(3, 200, 0.2)
    want = {}
    for user, own in by_user(rows).items():
        at = []
        for r in own:
            if len(at) < 3 and r[3] == ["view", "click", "buy"][len(at)]:
                at.append(r[1])
        if at:
            want[user] = (*at, *[None] * (3 - len(at)), len(at))
    out = journeys.funnel(spark.createDataFrame(rows, SCHEMA), "user", "ts", "id", "kind", ["view", "click", "buy"])
    assert {r["user"]: (r["at_1"], r["at_2"], r["at_3"], r["reached"]) for r in out.collect()} == want


@pytest.mark.parametrize("seed", [4, 5])
def test_completions_and_their_quantiles(spark, many_segments, seed):
    rows = some_events(seed)
    want = {}
    for own in by_user(rows).values():
        own = [r for r in own if r[3] in ("click", "buy")]
        for a, b in zip(own, own[1:] + [None]):
            if a[3] == "click":
                want[a[2]] = b[1] if b is not None and b[3] == "buy" else None
    found = journeys.completions(spark.createDataFrame(rows, SCHEMA), "user", "ts", "id", "kind", "click", "buy")
    assert {r["id"]: r["completed"] for r in found.collect()} == want
    exact = sorted(r["latency_micros"] for r in found.collect() if r["latency_micros"] is not None)
    halves = [journeys.quantile_sketch(found.where(F.col("id") % 2 == k).withColumn("g", F.lit(1)), ["g"], "latency_micros") for k in (0, 1)]
    merged = halves[0].unionByName(halves[1]).groupBy("g", "bucket").agg(F.sum("n").alias("n"))
    (r,) = journeys.sketch_quantiles(merged, ["g"], [0.1, 0.5, 0.99]).collect()
    for q, name in ((0.1, "q10"), (0.5, "q50"), (0.99, "q99")):
        x = exact[max(0, -int(-len(exact) * q // 1) - 1)]
        assert x <= r[name] <= x * (1 + 1 / 32) + 1
    assert r["n"] == len(exact)


def test_ranges(spark):
    rng = random.Random(6)
    bounds = [(f"r{i}", a, a + rng.choice([0, 0.5, 3, 400])) for i in range(80) for a in [rng.uniform(-50, 50)]]
    bounds += [("low", None, -20.0), ("high", 20.0, None), ("all", None, None), ("reversed", 5.0, 1.0)]
    values = [(i, rng.choice([None, rng.uniform(-60, 60), 7.0])) for i in range(300)] + [(900 + i, b[1]) for i, b in enumerate(bounds)]
    want = set()
    for i, v in values:
        hits = [n for n, a, b in bounds if v is not None and (a is None or v >= a) and (b is None or v < b) and not (a is not None and b is not None and a >= b)]
        want |= {(i, h) for h in hits} or {(i, None)}
    facts, table = spark.createDataFrame(values, "i int, v double"), spark.createDataFrame(bounds, "name string, a double, b double")
    for most in (4096, 3):
        out = ranges.range_lookup(facts, table, "v", "a", "b", ["name"], most_bins=most)
        assert {(r["i"], r["name"]) for r in out.collect()} == want and out.count() == len(want)
    assert {r["name"] for r in ranges.range_lookup(facts, table.limit(0), "v", "a", "b", ["name"]).collect()} == {None}
    assert ranges.range_lookup(facts.limit(0), table, "v", "a", "b", ["name"]).count() == 0
    plan = ranges.range_lookup(facts, table, "v", "a", "b", ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ranges_are_dealt_by_pairs(spark):
    """Few bytes, many pairs: tasks follow the pairs, a crowded bin is cut, and NULLs and copies stay whole."""
    values = [(i % 200, None if i % 10 == 0 else 5.0 if i % 2 else i % 97 / 1.0) for i in range(600)]
    bounds = [(i, float(i % 30), float(i % 30 + 40)) for i in range(90)]
    facts, table = spark.createDataFrame(values, "i int, v double").coalesce(1), spark.createDataFrame(bounds, "r int, a double, b double")
    want = Counter((i, r) for i, v in values for r in [n for n, a, b in bounds if v is not None and a <= v < b] or [None])
    out = ranges.range_lookup(facts, table, "v", "a", "b", ["r"], pairs_a_task=500)
    assert Counter((r["i"], r["r"]) for r in out.collect()) == want
    made = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(made) > 20 and max(made) < sum(want.values()) / 8


def test_currencies(spark):
    day = dt.date(2024, 1, 1)
    rates = [(day, "EUR", "USD", 1.25), (day, "USD", "JPY", 128.0), (day, "GBP", "USD", 1.5), (day, "USD", "EUR", 0.5),
             (day + dt.timedelta(3), "EUR", "GBP", 0.75), (day, "XXX", "USD", -1.0), (None, "EUR", "USD", 9.0), (day, "EUR", "USD", 2.0)]
    implied = currency.implied_rates(spark.createDataFrame(rates, "d date, b string, q string, r double"), "d", "b", "q", "r")
    got = {(str(r["date"])[-2:], r["base"], r["quote"]): (r["rate"], r["how"], r["between"]) for r in implied.collect()}
    assert got["01", "EUR", "USD"] == (1.25, 0, None) and got["01", "USD", "EUR"] == (0.5, 0, None)
    assert got["01", "JPY", "USD"] == (1 / 128.0, 1, None) and got["01", "EUR", "JPY"] == (160.0, 2, "USD")
    assert got["01", "GBP", "EUR"] == (0.75, 2, "USD") and ("01", "XXX", "USD") not in got and got["04", "GBP", "EUR"] == (1 / 0.75, 1, None)
    at = lambda n: dt.datetime(2024, 1, 1, 12) + dt.timedelta(n)
    facts = [(1, at(0), "GBP", 8.0), (2, at(2), "GBP", 8.0), (3, at(3), "GBP", 3.0), (4, at(9), "GBP", 1.0), (5, at(9), "EUR", 5.0),
             (6, at(-1), "USD", 1.0), (7, None, "USD", 1.0), (8, at(0), None, 1.0)]
    out = currency.convert(spark.createDataFrame(facts, "i int, t timestamp, c string, a double"), implied, "t", "c", ["a"], "EUR", max_age_days=2)
    assert {r["i"]: (r["a_eur"], r["rate_how"]) for r in out.collect()} == {
        1: (6.0, 2), 2: (6.0, 2), 3: (4.0, 1), 4: (None, None), 5: (5.0, None), 6: (None, None), 7: (None, None), 8: (None, None)}
