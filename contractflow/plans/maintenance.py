"""Workflows on stored tables: subject erasure, hard-delete reconciliation, retention, compaction."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog.policies import RETENTION
from ..contract import Contract
from ..operators import privacy, reconcile
from ..operators.schema import UNCAST, UNKNOWN
from ..sinks.tables import Tables


def erase_subjects(tables: Tables, contracts: Iterable[Contract], id_column: str, ids: Sequence | DataFrame, *,
                   strategy: str | None = None, salt: str = "", dry_run: bool = False,
                   partition: tuple[str, str] | None = None, old_salts: Sequence[str] = ()) -> list[dict]:
    """Erase subjects from every stored table that holds ``id_column``, and from its quarantine.

    Without a strategy each domain uses its own; a domain that rebuilds its tables from the others, or has no subjects, is
    only reported. Where a contract hashes the id, hashes under ``salt`` and ``old_salts`` are compared. Of a subject's
    quarantined rows the raw texts of failed casts and unknown fields go too. ``partition`` limits the change to one
    partition value, and then only that partition is rewritten.
    """
    report = []
    for contract in contracts:
        for name in (contract.name, f"quarantine_{contract.name}"):
            if not tables.exists(name):
                continue
            whole = df = tables.read(name)
            if id_column not in df.columns:
                continue
            hashed = id_column in contract.field_names and contract.field(id_column).mask == "hash"
            salts = list(dict.fromkeys(["", salt, *old_salts])) if hashed else None
            limited = partition and partition[0] in df.columns
            if limited:
                df = df.filter(F.col(partition[0]) == partition[1])
            hits = privacy.mark_subjects(df.select(id_column), id_column, ids, salts).filter("_subject").count()
            how = strategy or privacy.erasure_strategy(contract.domain)
            applied = bool(hits) and not dry_run and how not in ("rebuild", "not applicable")
            if applied:
                helpers = [c for c in (UNCAST, UNKNOWN) if c in whole.columns]
                pii = [c for c in contract.pii_fields if c in whole.columns]
                parts = tables.partition_columns(name)
                inside = limited and partition[0] in parts
                limit = F.col(partition[0]) == partition[1] if limited and not inside else None
                out = privacy.erase(df if inside else whole, id_column, ids, [*pii, *helpers], strategy=how, salt=salt, partition_filter=limit, salts=salts)
                if inside:
                    tables.overwrite_partitions(name, out)
                else:
                    tables.replace(name, out, parts)
            report.append({"table_name": name, "rows_touched": hits, "strategy": how, "applied": applied})
    return report


def reconcile_table(tables: Tables, contract: Contract, snapshot: DataFrame, *, stamp: str | None = None,
                    guards: reconcile.Guards = reconcile.Guards(), dry_run: bool = True,
                    now: datetime | None = None) -> dict:
    """Tombstone the keys of a stored table that a complete snapshot no longer has.

    ``stamp`` is the as-of column of the snapshot; it drives the age guard and spares
    rows updated after it.
    """
    now = now or datetime.now(timezone.utc)
    target, keys = tables.read(contract.name), list(contract.primary_key)
    age, options = None, {}
    if stamp:
        taken = reconcile.snapshot_time(snapshot.withColumn(stamp, F.unix_micros(stamp)), stamp).first()["snapshot_ts"]
        if taken is not None:
            age = (now.timestamp() - taken / 1e6) / 3600.0
            options = {"snapshot_ts": F.timestamp_micros(F.lit(taken))}
            if "updated_at" in target.columns:
                options["updated"] = "updated_at"
    out, report = reconcile.reconcile_guarded(target, snapshot, keys, now=F.lit(now), guards=guards, age_hours=age,
                                              dry_run=dry_run, **options)
    if report["tombstoned"] or report["resurrected"]:
        tables.replace(contract.name, out, tables.partition_columns(contract.name))
    return {"table_name": contract.name, **report}


def apply_retention(tables: Tables, contract: Contract, timestamp: str, as_of: Column) -> bool:
    """Drop rows older than the retention of the contract's domain and layer."""
    period = RETENTION.get(contract.domain, {}).get(contract.layer)
    if period is None or not tables.exists(contract.name):
        return False
    kept = privacy.retain(tables.read(contract.name), timestamp, period, as_of)
    tables.replace(contract.name, kept, tables.partition_columns(contract.name))
    return True
