"""Upserts, affected-key recomputation and reprocessing of slices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import deduplicate
from .joins import join_composite
from .schema import evolve


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], *,
                 guard: bool = True, evolution: str = "append") -> DataFrame:
    """Target rows whose key is not in the source, plus all source rows.

    ``guard`` makes the source unique per key first, so a key never comes in twice. A
    NULL in a composite key is a value like any other: a group without a city replaces
    the stored group without a city and does not pile up.
    """
    if guard:
        source = deduplicate(source, keys)
    target, source = evolve(target, source, evolution)
    kept = join_composite(target, source.select(*keys), keys, "left_anti", null_safe=True)
    return kept.select(*target.columns).unionByName(source)


def changed_keys(source: DataFrame, key: Column, name: str) -> DataFrame:
    return source.select(key.alias(name)).filter(F.col(name).isNotNull()).distinct()


def restrict_to_changed(df: DataFrame, key: Column, changed: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is among the changed keys (a one-column frame): a semi join that Spark plans by size."""
    name, probe = changed.columns[0], "_changed_key"
    return df.withColumn(probe, key).join(changed.withColumnRenamed(name, probe), probe, "left_semi").drop(probe)


def restrict_to_days(df: DataFrame, timestamp: str, changed_days: DataFrame) -> DataFrame:
    """Rows on the given days (a one-column date frame).

    The first and last day are subqueries that run before the scan and reach it as bounds on the raw timestamp, where
    Parquet statistics and partitions can skip data; the exact days are a semi join. Nothing runs while the plan is built.
    """
    name = changed_days.columns[0]
    low = changed_days.agg(F.min(name).cast("timestamp")).scalar()
    high = changed_days.agg(F.date_add(F.max(name), 1).cast("timestamp")).scalar()
    bounded = df.filter((F.col(timestamp) >= low) & (F.col(timestamp) < high))
    return restrict_to_changed(bounded, F.to_date(timestamp), changed_days)


def reprocess_slice(df: DataFrame, column: str, *, start=None, end=None, values: Sequence | None = None) -> DataFrame:
    """Rows to compute again: an inclusive range on a column, a list of values, or both."""
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end))
    if values is not None:
        df = df.filter(F.col(column).isin(list(values)))
    return df
