import datetime as dt
import json

import pytest

from contractflow.contract import Contract, Field, check_join_masks, fields
from contractflow.operators import quality, schema


def _contract(**kw):
    return Contract("c", "silver", "d", fields("id!", "n:integer", "amount:float", "day:date", "ok:boolean"), **kw)


def test_bad_values_become_null_and_stay_readable(spark):
    df = spark.createDataFrame(
        [("a", "1", "2.5", "2024-01-02", "true"), ("b", "x", "good", "", "maybe"), ("c", None, "", None, None)],
        "id string, n string, amount string, day string, ok string")
    typed, checks = schema.conform(df, _contract())
    rows = {r["id"]: r for r in typed.collect()}
    assert (rows["a"]["n"], rows["a"]["amount"], rows["a"]["day"], rows["a"]["ok"]) == (
        1, 2.5, dt.date(2024, 1, 2), True)
    assert rows["a"][schema.UNCAST] is None and rows["c"][schema.UNCAST] is None
    assert json.loads(rows["b"][schema.UNCAST]) == {"n": "x", "amount": "good", "ok": "maybe"}
    assert [c.rule for c in checks] == ["required:id"]


def test_missing_column_by_evolution(spark):
    df = spark.createDataFrame([("a", "1")], "id string, n string")
    typed, checks = schema.conform(df, _contract(evolution="append"))
    assert typed.first()["amount"] is None and len(checks) == 1
    typed, checks = schema.conform(df, _contract(evolution="strict"))
    good, bad = quality.split(quality.annotate(typed, checks))
    assert good.count() == 0
    assert [e["rule"] for e in bad.first()["_errors"]] == ["missing_field:amount", "missing_field:day", "missing_field:ok"]


@pytest.mark.parametrize("policy, columns, bad_rows", [("allow", {"id", "extra"}, 0), ("drop", {"id"}, 0),
                                                       ("quarantine", {"id", schema.UNKNOWN}, 1)])
def test_unknown_fields(spark, policy, columns, bad_rows):
    df = spark.createDataFrame([("a", "x"), ("b", None)], "id string, extra string")
    c = Contract("c", "silver", "d", fields("id!"), unknown_fields=policy)
    typed, checks = schema.conform(df, c)
    assert set(typed.columns) == columns
    assert quality.split(quality.annotate(typed, checks))[1].count() == bad_rows


def test_formats(spark):
    df = spark.createDataFrame([("20240131", "1706659200000000", "1706659200"), ("31.1.", "soon", "")],
                               "d string, us string, s string")
    c = Contract("c", "silver", "d", (Field("d", "date", fmt="yyyyMMdd"), Field("us", "timestamp", fmt="epoch_micros"),
                                      Field("s", "timestamp", fmt="epoch_seconds")))
    first, second = schema.conform(df, c)[0].select("d", "us", "s").collect()
    assert first["d"] == dt.date(2024, 1, 31) and first["us"] == first["s"] is not None
    assert tuple(second) == (None, None, None)


def test_schema_report(spark):
    df = spark.createDataFrame([("a", 1.0, 2)], "id string, n double, other int")
    rows = {(r["column"], r["status"]) for r in schema.schema_report(df, _contract()).collect()}
    assert rows == {("n", "type_differs"), ("other", "extra"), ("amount", "missing"), ("day", "missing"), ("ok", "missing")}


def test_evolve(spark):
    old, new = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, "x")], "a long, b string")
    left, right = schema.evolve(old, new, "append")
    assert left.columns == right.columns == ["a", "b"]
    assert left.unionByName(right).count() == 2
    with pytest.raises(ValueError):
        schema.evolve(old, new, "strict")


def test_catalog_is_complete():
    from contractflow.catalog import CONTRACTS

    layers = [c.layer for c in CONTRACTS.values()]
    assert [layers.count(x) for x in ("bronze", "silver", "gold")] == [22, 22, 22]
    every = [f for c in CONTRACTS.values() for f in c.fields]
    assert sum(f.mask == "hash" for f in every) == 34
    assert sum(f.mask == "redact" for f in every) == 15
    assert sum(f.foreign_key is not None for f in every) == 29
    # Known conflicts: these ids are hashed in the event tables and plain in the profiles.
    assert sorted(p.split(" is masked")[0] for p in check_join_masks(CONTRACTS)) == [
        "silver_hubspot_push_notifications.rider_id", "silver_rider_app_events.rider_id",
        "silver_trip_cancellations.driver_id", "silver_trip_cancellations.rider_id", "silver_trip_requests.rider_id"]
    for c in CONTRACTS.values():
        assert set(c.primary_key) <= set(c.field_names) and set(c.dedup_by) <= set(c.field_names)
