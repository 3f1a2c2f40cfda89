"""Point-in-time joins of facts to the versions of a type 2 dimension.

A join on the key with a range condition compares every fact of a key with every
version of that key. For a hot key that is a product of two large numbers in one
task. Both joins here merge facts and versions into one order instead and carry the last version
forward: by day over rows that the calendar bounds, by time over segments that split a hot key
(:mod:`.segments`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import packed, unpacked
from .segments import carried_forward, in_segments

UNKNOWN_KEY = "-1"


def or_unknown(surrogate: Column, unknown: str = UNKNOWN_KEY) -> Column:
    """Key of the unknown member where the lookup found nothing."""
    return F.coalesce(surrogate, F.lit(unknown))


def current_version(dim: DataFrame, current_flag: str = "is_current") -> DataFrame:
    return dim.filter(F.col(current_flag))


def _carry_forward(probes: DataFrame, versions: DataFrame, keys: Sequence[str], period: str,
                   same_period_counts: bool) -> DataFrame:
    """Probes (key, period) with ``_version``: the last version before, or up to, the period."""
    # Within a period a probe sorts after the versions it may see, else before them.
    probe_side = 2 if same_period_counts else 0
    both = versions.select(*keys, period, F.lit(1).alias("_side"), "_version").unionByName(
        probes.withColumn("_side", F.lit(probe_side)), allowMissingColumns=True
    )
    window = Window.partitionBy(*keys).orderBy(period, "_side").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("_version", F.last("_version", ignorenulls=True).over(window))
    return carried.filter(F.col("_side") != 1).drop("_side")


def asof_by_day(facts: DataFrame, dim: DataFrame, keys: Sequence[str], day: str, take: Sequence[str], *,
                effective_from: str = "effective_from", effective_to: str = "effective_to") -> DataFrame:
    """Version in force on ``day``, for facts with one row per key and day.

    Keeps every fact; ``take`` columns are NULL without a version. A version holds
    from its first day up to, not including, the day it ends; an open end never ends.
    Of several versions that start on one day only the last can hold on that day.
    """
    start, end = F.to_date(effective_from), F.to_date(effective_to)
    content = F.struct(end.alias("_end"), *[F.col(c).alias(f"_take_{c}") for c in take])
    filled = " AND ".join(f"{c} IS NOT NULL" for c in [*keys, effective_from])
    versions = (
        dim.filter(filled)
        .select(*keys, start.alias(day), F.col(effective_from).alias("_from"), content.alias("_content"))
        .groupBy(*keys, day)
        .agg(F.max_by("_content", "_from").alias("_version"))
    )
    names = [c for c in facts.columns if c not in keys and c != day]
    probes = facts.select(*keys, day, F.struct(*names).alias("_fact"))
    found = _carry_forward(probes, versions, keys, day, same_period_counts=True)
    holds = F.col("_version._end").isNull() | (F.col(day) < F.col("_version._end"))
    return found.select(
        *keys, day, *[F.col(f"_fact.{c}").alias(c) for c in names],
        *[F.when(holds, F.col(f"_version._take_{c}")).alias(c) for c in take],
    ).select(*facts.columns, *take)


def asof_by_time(facts: DataFrame, dim: DataFrame, keys: Sequence[str], timestamp: str, take: Sequence[str], *,
                 effective_from: str = "effective_from", effective_to: str = "effective_to",
                 fact_keys: Sequence[str] | None = None) -> DataFrame:
    """Version in force at the exact ``timestamp`` of each fact, ``[from, to)``.

    Keeps every fact; facts with a NULL key or timestamp find no version. Facts and versions are read once each, into one
    order of key and time. Of versions that start at one instant the one that holds longest counts, and a version
    ends no later than the next one starts. Hex strings, such as surrogate keys, travel in half their size.
    """
    fact_keys = list(fact_keys or keys)
    jk = [f"_k{i}" for i in range(len(keys))]
    texts = {t for t in take if dim.schema[t].dataType.simpleString() == "string"}
    content = F.struct(F.col(effective_to).alias("_to"), *[(packed(F.col(c)) if c in texts else F.col(c)).alias(f"_take_{c}") for c in take])
    filled = " AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, effective_from])
    open_last = F.coalesce(F.unix_micros(F.col(effective_to).cast("timestamp")), F.lit(2 ** 63 - 1))
    versions = dim.filter(filled).select(
        *[F.col(k).alias(j) for j, k in zip(jk, keys, strict=True)], F.col(effective_from).cast("timestamp").alias("_at"),
        F.lit(0).alias("_side"), open_last.alias("_rank"), content.alias("_version"), F.lit(None).alias("_fact"))
    # At one instant versions come before facts. The rank of a fact only spreads facts of one key and instant.
    probes = facts.select(
        *[F.col(k).alias(j) for j, k in zip(jk, fact_keys, strict=True)], F.col(timestamp).cast("timestamp").alias("_at"),
        F.lit(1).alias("_side"), F.monotonically_increasing_id().alias("_rank"), F.lit(None).alias("_version"),
        F.struct(*facts.columns).alias("_fact"))
    order = ["_at", "_side", "_rank"]
    merged = in_segments(versions.unionByName(probes), jk, order)
    found = carried_forward(merged, jk, order, "_version").filter(F.col("_side") == 1)
    holds = F.col("_at").isNotNull() & (F.col("_version._to").isNull() | (F.col("_at") < F.col("_version._to")))
    value = {t: unpacked(F.col(f"_version._take_{t}")) if t in texts else F.col(f"_version._take_{t}") for t in take}
    return found.select(*[F.col(f"_fact.{c}").alias(c) for c in facts.columns], *[F.when(holds, value[t]).alias(t) for t in take])
