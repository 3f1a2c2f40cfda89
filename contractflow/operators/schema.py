"""Schema enforcement: typed casts, required fields, unknown fields, schema reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract, Field

UNCAST = "_uncast"  # JSON of the raw values that did not fit their declared type
UNKNOWN = "_unknown"  # JSON of undeclared, filled columns


@dataclass(frozen=True)
class Check:
    """A named condition; a row for which it is false or NULL is bad."""

    rule: str
    category: str
    passes: Column


def to_text(df: DataFrame) -> DataFrame:
    """Every column as string, the shape of a raw layer."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def cast_field(c: Column, field: Field) -> Column:
    """Cast to the declared type, NULL where the text does not fit.

    ``fmt`` names a datetime pattern, or an epoch unit held as text.
    """
    if field.type in ("timestamp", "date") and field.fmt:
        if field.fmt == "epoch_micros":
            moment = F.timestamp_micros(c.try_cast("bigint"))
        elif field.fmt == "epoch_seconds":
            moment = F.timestamp_seconds(c.try_cast("bigint"))
        else:
            moment = F.try_to_timestamp(c.cast("string"), F.lit(field.fmt))
        return moment.cast(field.spark_type)
    return c.try_cast(field.spark_type)


def conform(df: DataFrame, contract: Contract, carry: Sequence[str] = (), *,
            cast_checks: bool = False) -> tuple[DataFrame, list[Check]]:
    """The declared projection of ``df`` plus the checks that enforcement adds.

    * A declared column that is absent becomes NULL under ``append`` evolution and
      fails every row under ``strict``.
    * Undeclared columns are kept, dropped, or sent to quarantine where filled.
    * Values that cannot be cast become NULL; their raw text is kept in ``_uncast``. With ``cast_checks`` such a row
      fails, so that it reaches quarantine with that text.
    * ``carry`` names helper columns that pass through and are not judged.
    """
    present = set(df.columns)
    checks: list[Check] = []
    columns: list[Column] = []
    failed: list[tuple[str, Column, Column]] = []
    for f in contract.fields:
        if f.name not in present:
            columns.append(F.lit(None).cast(f.spark_type).alias(f.name))
            if contract.evolution == "strict":
                checks.append(Check(f"missing_field:{f.name}", "schema", F.lit(False)))
            continue
        raw = F.col(f.name)
        if contract.cast_to_string or df.schema[f.name].dataType == f.spark_type:
            columns.append((raw.cast("string") if contract.cast_to_string else raw).alias(f.name))
            continue
        typed = cast_field(raw, f)
        columns.append(typed.alias(f.name))
        failed.append((f.name, raw, raw.isNotNull() & (raw.cast("string") != "") & typed.isNull()))
    for f in contract.fields:
        if f.required:
            checks.append(Check(f"required:{f.name}", "schema", F.col(f.name).isNotNull()))
        if f.accepted:
            # An empty optional value is not outside the vocabulary.
            member = F.col(f.name).isin(*f.accepted)
            checks.append(Check(f"accepted_values:{f.name}", "domain", F.col(f.name).isNull() | member))
    columns += [F.col(c) for c in carry]
    extra = [c for c in df.columns if c not in {*contract.field_names, *carry}]
    if contract.unknown_fields == "allow":
        columns += [F.col(c).cast("string").alias(c) if contract.cast_to_string else F.col(c) for c in extra]
    elif contract.unknown_fields == "quarantine" and extra:
        filled = reduce(Column.__or__, [F.col(c).isNotNull() for c in extra])
        columns.append(F.when(filled, F.to_json(F.struct(*extra))).alias(UNKNOWN))
        checks.append(Check("unknown_fields", "schema", F.col(UNKNOWN).isNull()))
    if failed:
        any_failed = reduce(Column.__or__, [bad for _, _, bad in failed])
        raw_values = F.struct(*[F.when(bad, raw.cast("string")).alias(name) for name, raw, bad in failed])
        columns.append(F.when(any_failed, F.to_json(raw_values)).alias(UNCAST))
        if cast_checks:
            uncast = F.get_json_object(UNCAST, "$")
            for name, _, _ in failed:
                fine = uncast.isNull() | F.get_json_object(UNCAST, f"$['{name}']").isNull()
                checks.append(Check(f"type:{name}", "schema", fine))
    return df.select(*columns), checks


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(UNCAST, UNKNOWN)


def schema_report(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per column that is missing, extra or of another type than declared."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    declared = {f.name: f.dataType.simpleString() for f in contract.to_struct_type().fields}
    rows = []
    for name in sorted(set(actual) | set(declared)):
        have, want = actual.get(name), declared.get(name)
        if have == want:
            continue
        status = "missing" if have is None else "extra" if want is None else "type_differs"
        rows.append((contract.name, name, status, want, have))
    schema = "contract string, column string, status string, declared string, actual string"
    return df.sparkSession.createDataFrame(rows, schema)


def evolve(target: DataFrame, incoming: DataFrame, evolution: str) -> tuple[DataFrame, DataFrame]:
    """Both frames with one schema. ``strict`` refuses columns the target lacks, but for lineage columns (``_name``)."""
    new = [f for f in incoming.schema.fields if f.name not in target.columns]
    refused = [f.name for f in new if not f.name.startswith("_")]
    if refused and evolution == "strict":
        raise ValueError(f"strict schema: new columns {refused}")
    for f in new:
        target = target.withColumn(f.name, F.lit(None).cast(f.dataType))
    columns = target.columns
    have = set(incoming.columns)
    aligned = [
        (F.col(c) if c in have else F.lit(None)).cast(target.schema[c].dataType).alias(c) for c in columns
    ]
    return target, incoming.select(*aligned)


def empty_frame(spark, contract: Contract) -> DataFrame:
    return spark.createDataFrame([], T.StructType(contract.to_struct_type().fields))
