"""Type 2 history and as-of joins against brute force, with hot keys."""

import datetime as dt
import random

import pytest

from contractflow.contract import Scd2
from contractflow.operators import asof, scd2

BASE = dt.datetime(2024, 1, 1)
SPEC = Scd2("sk", track=("a", "b"), timestamp="ts", version="v")


def _changes(seed: int, n: int, keys: int, hot: float, spread_days: int):
    """Rows of which a share of ``hot`` belongs to one key; instants repeat."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = 0 if rnd.random() < hot else rnd.randrange(keys)
        moment = BASE + dt.timedelta(minutes=rnd.randrange(spread_days * 24 * 60))
        rows.append((key, moment, rnd.choice(["x", "y", None]), rnd.randrange(2), i))
    return rows


def _brute(rows):
    """(key, from, to, a, b, note, version) by plain iteration."""
    best = {}
    for key, ts, a, b, note in rows:
        order = ((a is not None, a or ""), b, note)
        if (key, ts) not in best or order < best[(key, ts)][0]:
            best[(key, ts)] = (order, (a, b, note))
    out, by_key = [], {}
    for (key, ts), (_, values) in sorted(best.items(), key=lambda kv: kv[0]):
        by_key.setdefault(key, []).append((ts, values))
    for key, seq in by_key.items():
        cuts = [s for i, s in enumerate(seq) if i == 0 or s[1][:2] != seq[i - 1][1][:2]]
        for i, (ts, (a, b, note)) in enumerate(cuts):
            out.append((key, ts, cuts[i + 1][0] if i + 1 < len(cuts) else None, a, b, note, i + 1))
    return sorted(out, key=str)


def _rows(dim):
    return sorted(
        [(r["k"], r["effective_from"], r["effective_to"], r["a"], r["b"], r["note"], r["v"])
         for r in dim.collect() if r["sk"] != "-1"], key=str)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k int, ts timestamp, a string, b int, note int")


@pytest.fixture()
def many_segments(spark):
    """Sixteen segments, however few the rows."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("seed, hot, days", [(1, 0.0, 90), (2, 0.4, 90), (3, 0.9, 3), (4, 0.5, 400)])
def test_history_equals_brute_force(spark, many_segments, seed, hot, days):
    rows = _changes(seed, 400, 12, hot, days)
    dim = scd2.scd2_history(_frame(spark, rows), ["k"], SPEC)
    assert _rows(dim) == _brute(rows)
    unknown = [r for r in dim.collect() if r["sk"] == "-1"]
    assert len(unknown) == 1 and unknown[0]["is_current"]
    assert dim.select("sk").distinct().count() == dim.count()


@pytest.mark.parametrize("seed", [5, 6])
def test_batches_equal_history_and_reruns_change_nothing(spark, tables, seed):
    rows = sorted(_changes(seed, 300, 8, 0.4, 60), key=lambda r: r[1])
    cut1, cut2 = rows[100][1], rows[200][1]
    parts = [[r for r in rows if r[1] < cut1], [r for r in rows if cut1 <= r[1] < cut2], [r for r in rows if r[1] >= cut2]]
    tables.replace("dim", scd2.scd2_history(_frame(spark, parts[0]), ["k"], SPEC))
    for part in parts[1:]:
        tables.replace("dim", scd2.scd2_apply(tables.read("dim"), _frame(spark, part), ["k"], SPEC))
    dim = tables.read("dim")
    assert _rows(dim) == _brute(rows)
    again = scd2.scd2_apply(dim, _frame(spark, parts[2]), ["k"], SPEC)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, dim.collect()), key=str)


def test_late_and_equal_instants_are_ignored_and_reported(spark):
    dim = scd2.scd2_history(_frame(spark, [(1, BASE, "x", 0, 1)]), ["k"], SPEC)
    late = _frame(spark, [(1, BASE - dt.timedelta(days=1), "y", 0, 2), (1, BASE, "y", 0, 3)])
    out = scd2.scd2_apply(dim, late, ["k"], SPEC)
    assert _rows(out) == _rows(dim)
    assert scd2.late_rows(dim, late, ["k"], SPEC).count() == 2


def test_null_business_keys_and_empty_input(spark):
    assert scd2.scd2_history(_frame(spark, []), ["k"], SPEC).count() == 1
    dim = scd2.scd2_history(_frame(spark, [(None, BASE, "x", 0, 1)]), ["k"], SPEC)
    assert dim.count() == 1


def test_undated_source_starts_at_the_sentinel(spark):
    spec = Scd2("sk", track=("a",), unknown_member=None)
    df = spark.createDataFrame([("c1", "x"), ("c2", "y")], "k string, a string")
    dim = scd2.scd2_history(df, ["k"], spec)
    assert {r["effective_from"] for r in dim.collect()} == {dt.datetime(1900, 1, 1)}
    later = spark.createDataFrame([("c1", "z"), ("c2", "y"), ("c3", "n")], "k string, a string")
    out = scd2.scd2_snapshot_apply(dim, later, ["k"], spec, "2024-05-01 00:00:00")
    seen = {(r["k"], r["a"], r["effective_from"].year, r["is_current"]) for r in out.collect()}
    assert seen == {("c1", "x", 1900, False), ("c1", "z", 2024, True), ("c2", "y", 1900, True), ("c3", "n", 1900, True)}


def test_change_reason(spark):
    spec = Scd2("sk", track=("a",), timestamp="ts", change_reason="why", unknown_member=None)
    rows = [(1, BASE, "x", 0, 1), (1, BASE + dt.timedelta(1), "y", 0, 2)]
    assert {r["why"] for r in scd2.scd2_history(_frame(spark, rows), ["k"], spec).collect()} == {"initial", "attribute_change"}


def _in_force(versions, key, moment, as_date=False):
    def d(x):
        return x.date() if as_date and x is not None else x

    hits = [v for v in versions if v[0] == key and d(v[1]) <= moment and (v[2] is None or moment < d(v[2]))]
    assert len(hits) <= 1
    return hits[0][5] if hits else None


@pytest.mark.parametrize("seed, hot", [(7, 0.0), (8, 0.6), (9, 0.95)])
def test_asof_by_time(spark, many_segments, seed, hot):
    rows = _changes(seed, 300, 10, hot, 40)
    dim = scd2.scd2_history(_frame(spark, rows), ["k"], SPEC)
    versions = _brute(rows)
    rnd = random.Random(seed)
    facts = [(i, None if i % 37 == 0 else (0 if rnd.random() < hot else rnd.randrange(12)),
              None if i % 41 == 0 else BASE + dt.timedelta(minutes=rnd.randrange(-5000, 45 * 24 * 60))) for i in range(400)]
    facts += [(1000 + i, v[0], v[1]) for i, v in enumerate(versions[:50])]  # exactly on a boundary
    df = spark.createDataFrame(facts, "id int, rider int, at timestamp")
    out = asof.asof_by_time(df, dim, ["k"], "at", ["note"], fact_keys=["rider"])
    got = {r["id"]: r["note"] for r in out.collect()}
    assert out.count() == len(facts)
    assert got == {i: (None if k is None or t is None else _in_force(versions, k, t)) for i, k, t in facts}


def test_asof_by_day(spark):
    rows = _changes(11, 300, 10, 0.5, 40)
    dim = scd2.scd2_history(_frame(spark, rows), ["k"], SPEC)
    versions = _brute(rows)
    facts = [(k, (BASE + dt.timedelta(days=d)).date(), k * 100 + d) for k in range(12) for d in range(-3, 45)]
    df = spark.createDataFrame(facts, "k int, day date, n int")
    got = {(r["k"], r["day"]): (r["n"], r["note"]) for r in asof.asof_by_day(df, dim, ["k"], "day", ["note"]).collect()}
    assert got == {(k, d): (n, _in_force(versions, k, d, as_date=True)) for k, d, n in facts}


def test_asof_reads_both_sides_once_and_never_compares_pairs(spark, tmp_path):
    dim = scd2.scd2_history(_frame(spark, [(1, BASE, "x", 0, 1)]), ["k"], SPEC)
    df = spark.createDataFrame([(1, BASE)], "k int, at timestamp")
    df.write.parquet(str(tmp_path / "facts"))
    out = asof.asof_by_time(spark.read.parquet(str(tmp_path / "facts")), dim, ["k"], "at", ["note"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # What is left to do reads the stored merge; its one join is by segment.
    assert "facts" not in plan and plan.count("Join ") == 1 and "_segment" in plan


def test_asof_with_clashing_names_and_versions_that_do_not_hold(spark):
    """Versions of no length, gaps between versions, an instant with two versions, and columns named like helpers."""
    t = [BASE + dt.timedelta(days=d) for d in range(6)]
    dim = spark.createDataFrame([
        (1, t[0], t[1], "a"), (1, t[2], t[2], "never"), (1, t[2], t[3], "b"), (1, t[4], None, "c"), (2, t[0], t[0], "never"), (None, t[0], None, "no key")],
        "k int, effective_from timestamp, effective_to timestamp, note string")
    facts = spark.createDataFrame([(i, k, m) for i, (k, m) in enumerate([
        (1, t[0]), (1, t[1]), (1, t[2]), (1, t[3]), (1, t[5]), (2, t[0]), (3, t[0]), (None, t[0]), (1, None), (1, t[0] - dt.timedelta(1))])],
        "_segment int, k int, _at timestamp")
    out = asof.asof_by_time(facts, dim, ["k"], "_at", ["note"])
    assert out.columns == ["_segment", "k", "_at", "note"]
    assert {r["_segment"]: r["note"] for r in out.collect()} == {
        0: "a", 1: None, 2: "b", 3: None, 4: "c", 5: None, 6: None, 7: None, 8: None, 9: None}


def test_asof_carries_hex_keys_in_half_their_size(spark):
    """Strings come back as they were: digests, other hex, capitals, odd lengths, empty and NULL."""
    notes = ["ab" * 32, "0f", "0F", "abc", "", None, "no hex", "-1", "é"]
    dim = spark.createDataFrame([(i, BASE, None, n) for i, n in enumerate(notes)], "k int, effective_from timestamp, effective_to timestamp, note string")
    facts = spark.createDataFrame([(i, BASE) for i in range(len(notes) + 1)], "k int, at timestamp")
    out = asof.asof_by_time(facts, dim, ["k"], "at", ["note"])
    assert {r["k"]: r["note"] for r in out.collect()} == dict(enumerate([*notes, None])) and out.schema["note"].dataType.simpleString() == "string"
    merged = [row for f in out.inputFiles() for row in spark.read.parquet(f).where("_side = 0").collect()]
    assert {bytes(r["_version"]["_take_note"]["digest"]) for r in merged if r["_version"]["_take_note"]["digest"] is not None} == {b"\xab" * 32, b"\x0f", b""}


def test_hot_key_in_one_month_is_spread_evenly(spark, many_segments):
    """A key with a third of all rows, all in one hour: no segment holds much more than its share, and the history is right."""
    rows = [(0, BASE + dt.timedelta(milliseconds=i * 1000), "x" if i % 3 else "y", 0, i) for i in range(1600)]
    rows += [(1 + i % 300, BASE + dt.timedelta(days=i % 200, minutes=i), "x", i % 2, i) for i in range(3200)]
    from contractflow.operators.segments import in_segments

    dealt = in_segments(_frame(spark, rows), ["k"], ["ts"])
    sizes = [r["count"] for r in dealt.groupBy("_segment").count().collect()]
    assert max(sizes) <= 2.5 * sum(sizes) / len(sizes) and len(sizes) >= 12
    assert dealt.filter("k = 0").select("_segment").distinct().count() >= 4
    assert _rows(scd2.scd2_history(_frame(spark, rows), ["k"], SPEC)) == _brute(rows)
