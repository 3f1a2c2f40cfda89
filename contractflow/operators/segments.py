"""Ordered scans over keys of any size, by segments.

A window over a key puts all rows of the key into one task. Here rows are dealt by ranges of (key, order), so a segment is a
stretch of the whole order: small keys share one, a hot key goes over as many as its rows need. A window over (segment, key) then
sees an even share of rows, and what a row needs from before its segment is carried over the border from one row a segment.

The rows are written to the shared scratch folder as they are dealt. Bounds of ranges come from a sample, so a plan that is
evaluated twice could deal the rows twice in different ways; written rows are read by both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

SEGMENT = "_segment"


def in_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``_segment``, numbered in order of ``keys`` and ``order``, nulls first; stored.

    Rows that are equal in all these columns are in one segment, so ``order`` should tell the rows of a key apart.
    """
    dealt = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*keys, *order]])
    return stage(dealt.withColumn(SEGMENT, F.spark_partition_id()), "segments")


def last_before(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """One row a segment: ``_carried``, the last row before it with a ``value``, as a struct of the keys and the value.

    A key that goes on from an earlier segment is the one of the carried row, or has no value so far. This is the one place where
    segments are looked at together: as many rows as there were tasks.
    """
    place = F.struct(*[F.col(c) for c in [*keys, *order]])
    filled = F.col(value).isNotNull()
    own = rows.groupBy(SEGMENT).agg(F.max_by(F.when(filled, F.struct(*keys, value)), F.when(filled, place)).alias("_own"))
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    return own.select(SEGMENT, F.last("_own", ignorenulls=True).over(before).alias("_carried"))


def carried_forward(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Rows of :func:`in_segments` with the last non-null ``value`` of the key up to each row, in place of its own."""
    window = Window.partitionBy(SEGMENT, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(
        Window.unboundedPreceding, 0)
    inside = rows.withColumn("_inside", F.last(value, ignorenulls=True).over(window))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_carried.{k}"))
    carried = inside.join(last_before(rows, keys, order, value), SEGMENT, "left")
    from_before = F.when(F.col("_carried").isNotNull() & same, F.col(f"_carried.{value}"))
    return carried.withColumn(value, F.coalesce("_inside", from_before)).drop("_inside", "_carried")
