"""Shorthand for catalog entries. Policies are the per-layer defaults of a domain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from ..contract import Contract, Field, ForeignKey, Rule, Scd2, Source, Transform, fields

HOURLY, DAILY = "y_%Y/m_%m/d_%d/h_%H", "y_%Y/m_%m/d_%d"


def _fields(spec: str, *, pii: Sequence[str] = (), hash: Sequence[str] = (), redact: Sequence[str] = (),
            fks: Mapping[str, str] | None = None, accepted: Mapping[str, Sequence[str]] | None = None,
            formats: Mapping[str, str] | None = None) -> tuple[Field, ...]:
    out = []
    for f in fields(*spec.split()):
        mask = "hash" if f.name in hash else "redact" if f.name in redact else None
        target = (fks or {}).get(f.name)
        out.append(replace(
            f, mask=mask, pii=f.name in pii or mask is not None,
            foreign_key=ForeignKey(*target.split(".")) if target else None,
            accepted=tuple((accepted or {}).get(f.name, ())), fmt=(formats or {}).get(f.name)))
    return tuple(out)


def bronze(name: str, domain: str, spec: str, *, fmt: str = "csv", load: str = "incremental",
           folders: str | None = HOURLY, pii=(), fks=None, accepted=None, rules: Sequence[Rule] = ()) -> Contract:
    """Raw landing table: all columns text, appended, unknown columns kept."""
    return Contract(
        name=f"bronze_{name}", layer="bronze", domain=domain,
        fields=_fields(spec, pii=pii, fks=fks, accepted=accepted),
        source=Source(fmt, name, load, folders), rules=tuple(rules), strategy="append",
        evolution="append", unknown_fields="allow", cast_to_string=True)


def silver(name: str, domain: str, spec: str, source: str, *, key: str = "", dedup: str | None = None,
           latest_by: str | None = None, rules: Sequence[Rule] = (), unique: Sequence[str] = (), hash=(), redact=(),
           fks=None, formats=None, drop=(), strategy: str = "merge", evolution: str = "strict",
           unknown: str = "quarantine", registered: bool = True, transform: Transform | None = None) -> Contract:
    """Typed, deduplicated, checked and masked table."""
    keys = tuple(key.split())
    return Contract(
        name=f"silver_{name}", layer="silver", domain=domain,
        fields=_fields(spec, hash=hash, redact=redact, fks=fks, formats=formats), primary_key=keys,
        source=Source("table", source), dedup_by=tuple((dedup or key).split()), latest_by=latest_by,
        rules=tuple(rules), unique=tuple(tuple(u.split()) for u in unique), drop=tuple(drop), strategy=strategy,
        evolution=evolution, unknown_fields=unknown, registered=registered, transform=transform)


def gold(name: str, domain: str, spec: str, source: str | Source, *, key: str, links: Mapping[str, str] | None = None,
         transform: Transform | None = None, rules: Sequence[Rule] = (), unique: Sequence[str] = (), fks=None,
         accepted=None, strategy: str = "merge", scd2: Scd2 | None = None, natural_key: str = "",
         evolution: str = "append", registered: bool = True, pii=(), partition_by: Sequence[str] = ()) -> Contract:
    """Data product; its transform builds the declared columns."""
    return Contract(
        name=f"gold_{name}", layer="gold", domain=domain, fields=_fields(spec, pii=pii, fks=fks, accepted=accepted),
        primary_key=tuple(key.split()), natural_key=tuple(natural_key.split()),
        source=source if isinstance(source, Source) else Source("table", source), links=dict(links or {}),
        transform=transform, rules=tuple(rules), unique=tuple(tuple(u.split()) for u in unique), strategy=strategy,
        scd2=scd2, evolution=evolution, unknown_fields="drop", registered=registered, partition_by=tuple(partition_by))
