"""Key spines and joins on composite keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_spine(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The distinct keys that occur in any of the frames."""
    return reduce(DataFrame.unionByName, [f.select(*keys).distinct() for f in frames]).distinct()


def join_composite(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", *,
                   null_safe: bool = False) -> DataFrame:
    """Join on several keys. By default NULL keys match nothing; ``null_safe`` lets them match."""
    if not null_safe:
        return left.join(right, list(keys), how)
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def join_on_spine(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Frames aggregated to one row per key, side by side. All joins share one partitioning."""
    return reduce(lambda acc, f: acc.join(f, list(keys), "left"), frames, key_spine(frames, keys))
