"""Lookup in ranges without an equal key, such as the tier of a multiplier.

Ranges and values meet in bins of one width, so the join has a key; the exact bounds are compared within a bin. The width is taken
from the ranges: about that of a middling one, but so that no range covers more than ``most_bins`` bins.

Where many ranges overlap, the pairs grow with facts times ranges, and files of a few megabytes make billions of them. So facts and ranges
are counted by bin first; where there are many pairs a fact, facts are dealt over tasks by pairs and not by bytes, and a crowded bin is cut:
each fact goes to one piece of it, its ranges to all pieces. Equal facts stay together.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def range_lookup(facts: DataFrame, ranges: DataFrame, value: str, low: str, high: str, take: Sequence[str], *,
                 most_bins: int = 4096, pairs_a_task: int = 1 << 26) -> DataFrame:
    """Every fact with the ``take`` columns of each range ``[low, high)`` that holds its ``value``; NULL where none does.

    A NULL bound is open. Ranges may overlap; a range whose bounds are equal or reversed holds nothing, and a NULL value is in none.
    """
    seen = facts.agg(F.min(F.col(value).cast("double")).alias("low"), F.max(F.col(value).cast("double")).alias("high"))
    # Only where values are do ranges matter, so open ends stop at the least and the greatest value.
    start = F.greatest(F.coalesce(F.col(low).cast("double"), F.col("_seen.low")), F.col("_seen.low"))
    end = F.least(F.coalesce(F.col(high).cast("double"), F.col("_seen.high")), F.col("_seen.high"))
    first, last = seen.first()
    bounds = F.struct(F.lit(first).cast("double").alias("low"), F.lit(last).cast("double").alias("high"))
    real = F.col(low).isNull() | F.col(high).isNull() | (F.col(low) < F.col(high))
    clipped = ranges.where(real).withColumn("_seen", bounds).withColumns({"_start": start, "_end": end}).where("_start <= _end")
    middling = clipped.agg(F.percentile_approx(F.col("_end") - F.col("_start"), 0.5)).first()[0] or 0.0
    span = (last - first) if first is not None else 0.0
    width = max(middling, span / most_bins) or 1.0
    bins = F.sequence(F.floor(F.col("_start") / width), F.floor(F.col("_end") / width))
    binned = clipped.select(F.explode(bins).alias("_range_bin"), F.col(low).alias("_low"), F.col(high).alias("_high"),
                            *[F.col(c).alias(f"_take_{c}") for c in take])
    keyed = facts.withColumn("_bin", F.floor(F.col(value).cast("double") / width))
    inside = (F.col("_low").isNull() | (F.col(value) >= F.col("_low"))) & (F.col("_high").isNull() | (F.col(value) < F.col("_high")))
    keyed, binned, on = _dealt(keyed, binned, pairs_a_task)
    joined = keyed.join(binned, on & inside, "left")
    return joined.select(*facts.columns, *[F.col(f"_take_{c}").alias(c) for c in take])


def _dealt(keyed: DataFrame, binned: DataFrame, pairs_a_task: int) -> tuple[DataFrame, DataFrame, Column]:
    """Facts and ranges so that a task has about ``pairs_a_task`` pairs to compare, and the condition they meet on."""
    on = F.col("_bin") == F.col("_range_bin")
    a_piece = max(1, pairs_a_task // 2)
    counts = keyed.groupBy("_bin").agg(F.count("*").alias("_n")).join(
        binned.groupBy("_range_bin").agg(F.count("*").alias("_m")), on, "left")
    counts = counts.withColumn("_pairs", F.col("_n").cast("double") * F.greatest(F.coalesce("_m", F.lit(1)), F.lit(1)))
    crowded = F.when(F.col("_bin").isNotNull() & (F.col("_pairs") > a_piece), F.struct("_bin", F.ceil(F.col("_pairs") / a_piece).alias("_pieces")))
    rows, pairs, cut = counts.agg(F.sum("_n"), F.sum("_pairs"), F.collect_list(crowded)).first()  # no more bins than there will be tasks
    if not rows or pairs <= pairs_a_task or pairs <= 8 * rows:
        return keyed, binned, on
    tasks = int(-(-pairs // pairs_a_task))
    values = json.dumps([[int(b), int(n)] for b, n in cut])
    pieces = keyed.sparkSession.range(1).select(F.explode(F.from_json(F.lit(values), "array<array<bigint>>")).alias("_cut")).select(
        F.col("_cut")[0].alias("_cut_bin"), F.col("_cut")[1].alias("_pieces"))
    spread = F.xxhash64(*[f.name for f in keyed.schema if "map<" not in f.dataType.simpleString()])
    of = F.when(F.col("_bin").isNull(), F.lit(tasks)).otherwise(F.coalesce("_pieces", F.lit(1)))  # a NULL meets no range
    keyed = keyed.join(pieces, F.col("_bin") == F.col("_cut_bin"), "left").withColumn("_piece", F.pmod(spread, of)).drop("_cut_bin", "_pieces")
    binned = binned.join(pieces, F.col("_range_bin") == F.col("_cut_bin"), "left").withColumn(
        "_range_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)) - 1))).drop("_cut_bin", "_pieces")
    return keyed.repartition(tasks, "_bin", "_piece"), binned, on & (F.col("_piece") == F.col("_range_piece"))
