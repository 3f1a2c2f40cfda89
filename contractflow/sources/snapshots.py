"""Tables and key snapshots by name or by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_any(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    """``table:name`` or a bare name from the catalog; anything with a slash as files."""
    if target.startswith("table:"):
        return spark.table(target.removeprefix("table:"))
    if "/" in target:
        return spark.read.format(fmt).load(target)
    return spark.table(target)


def read_parquet_utc(spark: SparkSession, path: str) -> DataFrame:
    """Parquet whose zone-less timestamps are read as instants in UTC.

    Declaring the type in the read schema, not by a cast, keeps filters on it pushable.
    """
    schema = spark.read.parquet(path).schema
    ntz = [f for f in schema.fields if f.dataType == T.TimestampNTZType()]
    if not ntz:
        return spark.read.parquet(path)
    fields = [
        T.StructField(f.name, T.TimestampType(), f.nullable) if f in ntz else f for f in schema.fields
    ]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def key_snapshot(df: DataFrame, keys: list[str], stamp: str | None = None) -> DataFrame:
    """Only the key columns, and the as-of column where there is one."""
    return df.select(*keys, *([F.col(stamp)] if stamp else []))
