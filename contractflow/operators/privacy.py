"""Masking at write, erasure of data subjects, and retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import Contract
from ..functions.calendar import older_than
from ..functions.masks import mask_hash, mask_nullify, mask_redact

# Erasure strategy and retention by domain and layer.
DOMAIN_ERASURE = {
    "marketplace": "nullify",
    "payments": "hash",
    "marketing": "redact",
    "shared": "rebuild",
    "reference": "not applicable",
}
LAYER_RETENTION = {"bronze": "P7D", "silver": "P90D", "gold": "P7Y"}


def apply_masks(df: DataFrame, contract: Contract, salt: str = "") -> DataFrame:
    """Hash or redact the columns that the contract marks."""
    masked = {}
    for f in contract.fields:
        if f.mask == "hash":
            masked[f.name] = mask_hash(F.col(f.name), salt)
        elif f.mask == "redact":
            masked[f.name] = mask_redact(F.col(f.name))
    return df.withColumns(masked) if masked else df


def _erased(c: str, data_type, strategy: str, salt: str) -> Column:
    if strategy == "nullify":
        return mask_nullify(F.col(c), data_type)
    if data_type.typeName() != "string":
        return mask_nullify(F.col(c), data_type)  # a hash or a text does not fit the column
    return mask_hash(F.col(c), salt) if strategy == "hash" else mask_redact(F.col(c))


def erase(df: DataFrame, id_column: str, ids: Sequence | DataFrame, pii: Sequence[str], *,
          strategy: str = "nullify", salt: str = "", partition_filter: Column | None = None,
          salts: Sequence[str] | None = None) -> DataFrame:
    """The table with the personal data of the given subjects removed.

    ``ids`` is a list or a frame with ``id_column``. ``partition_filter`` limits
    which rows may change; the others are returned as they are. ``salts``: see :func:`mark_subjects`.
    """
    if strategy not in ("nullify", "hash", "redact"):
        raise ValueError(f"unknown erasure strategy {strategy!r}")
    marked = mark_subjects(df, id_column, ids, salts)
    hit = F.col("_subject") if partition_filter is None else F.col("_subject") & F.coalesce(partition_filter, F.lit(False))
    out = [
        F.when(hit, _erased(c, df.schema[c].dataType, strategy, salt)).otherwise(F.col(c)).alias(c)
        if c in pii else F.col(c)
        for c in df.columns
    ]
    return marked.select(*out)


def mark_subjects(df: DataFrame, id_column: str, ids: Sequence | DataFrame, salts: Sequence[str] | None = None) -> DataFrame:
    """``df`` with ``_subject``: whether the row belongs to one of the ids.

    Ids are compared as text, so that an id given as text meets a numeric column. Where the column holds hashes, ``salts``
    names all salts they were made with, and the hashes of the ids are compared.
    """
    if not isinstance(ids, DataFrame):
        ids = df.sparkSession.createDataFrame([(None if i is None else str(i),) for i in ids], f"`{id_column}` string")
    own = F.col(id_column).cast("string")
    keys = [own] if salts is None else [mask_hash(own, salt) for salt in salts]
    # Distinct ids against an arbitrary number of rows: Spark picks the join by size,
    # and adaptive execution splits a subject that owns very many rows.
    known = ids.select(F.explode(F.array(*keys)).alias("_id")).filter("_id IS NOT NULL").distinct().withColumn("_hit", F.lit(True))
    return (
        df.join(known, F.col(id_column).cast("string") == F.col("_id"), "left")
        .withColumn("_subject", F.col("_hit").isNotNull())
        .drop("_id", "_hit")
    )


def erasure_report(tables: Mapping[str, DataFrame], id_column: str, ids: Sequence | DataFrame,
                   salts: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Rows that an erasure would touch, per table that holds the id column. ``salts`` has those of each table that holds hashed ids."""
    parts = [
        mark_subjects(df.select(id_column), id_column, ids, (salts or {}).get(name)).agg(
            F.lit(name).alias("table_name"), F.count_if(F.col("_subject")).alias("rows_touched")
        )
        for name, df in tables.items()
        if id_column in df.columns
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def erasure_strategy(domain: str) -> str:
    return DOMAIN_ERASURE.get(domain, "nullify")


def retain(df: DataFrame, timestamp: str, period: str, as_of: Column) -> DataFrame:
    """Rows inside the retention period; rows without a timestamp stay."""
    return df.filter(~F.coalesce(older_than(F.col(timestamp), period, as_of), F.lit(False)))
