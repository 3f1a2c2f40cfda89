"""One row per key.

Both forms filter ``row_number() == 1``. Spark turns that into a per-task limit
before the shuffle, so a key with very many copies sends one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Column | None) -> DataFrame:
    partition = list(keys)
    if keep is not None:
        # A row to keep forms a group of its own, so the limit per task still applies.
        df = df.withColumn("_own", F.when(keep, F.monotonically_increasing_id()))
        partition.append("_own")
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank", "_own")


def _orderable(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields if f.name not in keys and f.dataType.typeName() != "map"]


def deduplicate(df: DataFrame, keys: Sequence[str], *, keep: Column | None = None) -> DataFrame:
    """One row per key: the smallest by all remaining columns in declared order, NULLs first.

    Rows for which ``keep`` is true are all kept and stand in for no other row.
    """
    rest = _orderable(df, keys)
    if not rest and keep is None:
        return df.dropDuplicates(list(keys))
    order = [F.col(c).asc_nulls_first() for c in rest] or [F.lit(1)]
    return _first_per_key(df, keys, order, keep)


def deduplicate_by_latest(df: DataFrame, keys: Sequence[str], timestamp: str, *,
                          keep: Column | None = None) -> DataFrame:
    """The newest row per key; ties fall to the smallest remaining columns."""
    rest = [c for c in _orderable(df, keys) if c != timestamp]
    order = [F.col(timestamp).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in rest]]
    return _first_per_key(df, keys, order, keep)
