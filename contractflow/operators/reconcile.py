"""Hard-delete reconciliation against a complete key snapshot, by soft deletes only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tombstone:
    flag: str = "is_deleted"
    at: str = "deleted_at"
    reason: str = "delete_reason"


@dataclass(frozen=True)
class Guards:
    min_snapshot_rows: int = 1
    max_age_hours: float = 26.0  # 0 switches the check off
    max_delete_percent: float = 20.0


def with_tombstone_columns(df: DataFrame, t: Tombstone = Tombstone()) -> DataFrame:
    """Add the tombstone columns where missing. A NULL flag means active."""
    types = {t.flag: "boolean", t.at: "timestamp", t.reason: "string"}
    return df.withColumns({c: F.lit(None).cast(k) for c, k in types.items() if c not in df.columns})


def snapshot_time(snapshot: DataFrame, column: str) -> DataFrame:
    """The as-of moment of a snapshot: the newest stamp in it."""
    return snapshot.agg(F.max(column).alias("snapshot_ts"))


def _lost(present: Column, t: Tombstone, updated: str | None, snapshot_ts: Column | None) -> Column:
    """Active, absent from the snapshot and not newer than it."""
    gone = ~F.coalesce(F.col(t.flag), F.lit(False)) & present.isNull()
    if updated is not None and snapshot_ts is not None:
        gone = gone & (F.col(updated) <= snapshot_ts)
    return gone


def _keys(snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    return snapshot.select(*keys).distinct().withColumn("_present", F.lit(True))


def reconcile_counts(target: DataFrame, snapshot: DataFrame, keys: Sequence[str], *, t: Tombstone = Tombstone(),
                     updated: str | None = None, snapshot_ts: Column | None = None) -> DataFrame:
    """One row with the counts all guards need, from a single join of keys."""
    target = with_tombstone_columns(target, t)
    columns = [*keys, t.flag] + ([updated] if updated else [])
    left = target.select(*columns).withColumn("_stored", F.lit(True))
    both = left.join(_keys(snapshot, keys), list(keys), "full_outer")
    stored, present = F.col("_stored").isNotNull(), F.col("_present").isNotNull()
    active = stored & ~F.coalesce(F.col(t.flag), F.lit(False))
    return both.agg(
        F.count_if(active).alias("active"),
        F.count_if(present).alias("snapshot_keys"),
        F.count_if(stored & _lost(F.col("_present"), t, updated, snapshot_ts)).alias("candidates"),
        F.count_if(stored & present & F.coalesce(F.col(t.flag), F.lit(False))).alias("returned"),
    )


def refusal(counts, guards: Guards, age_hours: float | None = None) -> str | None:
    """Why a snapshot must not be applied, or None."""
    if counts["snapshot_keys"] < guards.min_snapshot_rows:
        return f"snapshot has {counts['snapshot_keys']} keys, fewer than {guards.min_snapshot_rows}"
    if guards.max_age_hours and age_hours is not None and age_hours > guards.max_age_hours:
        return f"snapshot is {age_hours:.1f} h old, more than {guards.max_age_hours} h"
    if counts["active"] and 100.0 * counts["candidates"] / counts["active"] > guards.max_delete_percent:
        return f"{counts['candidates']} of {counts['active']} active rows would be deleted"
    return None


def reconcile(target: DataFrame, snapshot: DataFrame, keys: Sequence[str], *, now: Column,
              t: Tombstone = Tombstone(), reason: str = "missing_in_snapshot", updated: str | None = None,
              snapshot_ts: Column | None = None) -> DataFrame:
    """The target with lost keys flagged and returned keys cleared. No row is removed."""
    target = with_tombstone_columns(target, t)
    joined = target.join(_keys(snapshot, keys), list(keys), "left")
    lost = _lost(F.col("_present"), t, updated, snapshot_ts)
    back = F.coalesce(F.col(t.flag), F.lit(False)) & F.col("_present").isNotNull()

    def updated_value(on_lost: Column, column: str, on_back: Column) -> Column:
        return F.when(lost, on_lost).when(back, on_back).otherwise(F.col(column)).alias(column)

    changed = {
        t.flag: updated_value(F.lit(True), t.flag, F.lit(False)),
        t.at: updated_value(now.cast("timestamp"), t.at, F.lit(None).cast("timestamp")),
        t.reason: updated_value(F.lit(reason), t.reason, F.lit(None).cast("string")),
    }
    return joined.select(*[changed.get(c, F.col(c)) for c in target.columns])


def reconcile_guarded(target: DataFrame, snapshot: DataFrame, keys: Sequence[str], *, now: Column,
                      guards: Guards = Guards(), age_hours: float | None = None, dry_run: bool = False,
                      **options) -> tuple[DataFrame, dict]:
    """Check the guards on one row of counts, then apply. Returns the table and a report."""
    shared = {k: v for k, v in options.items() if k != "reason"}
    counts = reconcile_counts(target, snapshot, keys, **shared).first().asDict()
    report = {**counts, "aborted": refusal(counts, guards, age_hours), "dry_run": dry_run,
              "tombstoned": 0, "resurrected": 0}
    if report["aborted"] or dry_run:
        return with_tombstone_columns(target, options.get("t", Tombstone())), report
    report.update(tombstoned=counts["candidates"], resurrected=counts["returned"])
    return reconcile(target, snapshot, keys, now=now, **options), report
