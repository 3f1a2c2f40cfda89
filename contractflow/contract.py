"""Declarative description of one table: types, keys, rules, masks and load strategy."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SPARK_TYPES: Mapping[str, T.DataType] = {
    "string": T.StringType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}

# Columns that may tell when a row of a source last changed.
CHANGE_COLUMNS = ("updated_at", "last_modified", "event_timestamp", "created_at")


@dataclass(frozen=True)
class ForeignKey:
    contract: str
    column: str


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    required: bool = False
    pii: bool = False
    mask: str | None = None  # "hash" | "redact"
    accepted: tuple[str, ...] = ()
    foreign_key: ForeignKey | None = None
    fmt: str | None = None  # datetime pattern, "epoch_micros" or "epoch_seconds"
    extract: str | None = None  # regular expression with one group, for documents

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.type]


@dataclass(frozen=True)
class Rule:
    """A predicate that must be true for a row to be good."""

    name: str
    sql: str
    category: str = "quality"
    severity: str = "high"


@dataclass(frozen=True)
class Source:
    format: str = "table"  # csv | json | parquet | text | table
    path: str = ""
    load_mode: str = "full"  # full | incremental
    partition_format: str | None = None  # e.g. y_%Y/m_%m/d_%d/h_%H
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Scd2:
    surrogate_key: str
    track: tuple[str, ...]
    timestamp: str | None = None
    effective_from: str = "effective_from"
    effective_to: str = "effective_to"
    current_flag: str = "is_current"
    version: str | None = None
    change_reason: str | None = None
    unknown_member: str | None = "-1"
    buckets: int = 0  # the stored table is cut by a hash of the key, and open versions are kept apart; 0: one whole


# A transform receives {"source": df, <link name>: df, ...} and returns a DataFrame.
Transform = Callable[[Mapping[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class Contract:
    name: str
    layer: str  # bronze | silver | gold
    domain: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...] = ()
    natural_key: tuple[str, ...] = ()
    source: Source = Source()
    links: Mapping[str, str] = field(default_factory=dict)
    transform: Transform | None = None
    drop: tuple[str, ...] = ()
    dedup_by: tuple[str, ...] = ()
    latest_by: str | None = None
    dedup_before_rules: bool = False
    rules: tuple[Rule, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    strategy: str = "overwrite"  # append | merge | overwrite | scd2
    scd2: Scd2 | None = None
    evolution: str = "append"  # append | strict
    unknown_fields: str = "drop"  # allow | drop | quarantine
    cast_to_string: bool = False
    partition_by: tuple[str, ...] = ()
    registered: bool = True
    system: str = ""
    change_columns: tuple[str, ...] = CHANGE_COLUMNS  # the first that exists tells how new the source is

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def pii_fields(self) -> list[str]:
        return [f.name for f in self.fields if f.pii or f.mask]

    def to_struct_type(self) -> T.StructType:
        """Columns of the stored table, with the mechanics of a type 2 dimension."""
        declared = [
            T.StructField(f.name, T.StringType() if self.cast_to_string else f.spark_type) for f in self.fields
        ]
        if self.scd2 is None:
            return T.StructType(declared)
        s = self.scd2
        mechanics = [
            T.StructField(s.effective_from, T.TimestampType()), T.StructField(s.effective_to, T.TimestampType()),
            T.StructField(s.current_flag, T.BooleanType()),
        ]
        if s.version:
            mechanics.append(T.StructField(s.version, T.LongType()))
        return T.StructType([T.StructField(s.surrogate_key, T.StringType()), *declared, *mechanics])

    def with_(self, **changes: Any) -> Contract:
        return replace(self, **changes)


def fields(*specs: str, **overrides: Mapping[str, Any]) -> tuple[Field, ...]:
    """Fields from short texts: ``"trip_id!"`` is required, ``"fare:float"`` is typed.

    Keyword arguments add further attributes to single fields.
    """
    out = []
    for spec in specs:
        text = spec.rstrip("!")
        name, _, kind = text.partition(":")
        out.append(Field(name, kind or "string", required=spec.endswith("!"), **overrides.get(name, {})))
    return tuple(out)


def check_join_masks(contracts: Mapping[str, Contract]) -> list[str]:
    """Foreign keys whose two ends are masked differently and so can never match."""
    problems = []
    for contract in contracts.values():
        for f in contract.fields:
            fk = f.foreign_key
            if fk is None or fk.contract not in contracts:
                continue
            other = contracts[fk.contract]
            if other.scd2 and fk.column == other.scd2.surrogate_key:
                continue
            if fk.column not in other.field_names:
                problems.append(f"{contract.name}.{f.name}: {fk.contract} has no column {fk.column}")
            elif other.field(fk.column).mask != f.mask:
                problems.append(
                    f"{contract.name}.{f.name} is masked {f.mask or 'not at all'}, "
                    f"{fk.contract}.{fk.column} {other.field(fk.column).mask or 'not at all'}"
                )
    return problems
