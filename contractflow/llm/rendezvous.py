"""Sharding by weighted rendezvous hashing of a stable record key.

Every shard draws a score for a key, and the lowest score wins. With ``u`` uniform in (0, 1) from a hash of key and shard,
``-ln(u) / weight`` is exponential with rate ``weight``, so a shard wins in proportion to its weight. A new shard can only
win keys for itself, and a removed one gives up only its own keys. Scores need no table, no shuffle and no state.

Cases: a null key is a key like any other; repeated rows share a shard and get a slot each; a null text has no bytes.
Weights must be positive. An empty table gives an empty result. Columns beside key and text are not read and cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .base import query, read


def shard_score(key: Column, shard: int, weight: float = 1.0) -> Column:
    """The score of one shard for a key; lowest wins."""
    bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(key.cast("string"), F.lit("\u0000")), F.lit(shard)), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The number of the shard that a key belongs to; shard ``i`` has ``weights[i]``."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    return F.array_min(F.array(*[
        F.struct(shard_score(key, i, w).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)
    ]))["shard"]


def assign_shards(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text",
                  grown: Sequence[float] | None = None) -> DataFrame:
    """Key, size, checksum and shard of every row, and with ``grown`` its shard under those weights.

    ``slot`` numbers the rows of a shard without gaps. Rows are numbered inside the task that read them and moved up by
    what earlier tasks hold of the shard, so no task ever sees more than one input split, however hot a key or shard is.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        (rendezvous(F.col(key), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_at"),
    ).withColumn("_split", F.shiftright("_at", 33))
    rows = stage(rows, "shards")  # row numbers must not change when a lost task runs again
    held = rows.groupBy("shard", "_split").agg(F.count("*").alias("_n"))
    before = held.select("shard", "_split", F.coalesce(F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    numbered = rows.withColumn("_nr", F.row_number().over(Window.partitionBy("shard", "_split").orderBy("_at")) - 1)
    return numbered.join(before, ["shard", "_split"]).select(
        key, "size", "text_crc32", "shard", (F.col("_before") + F.col("_nr")).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, weights: Sequence[float], path: str, key: str = "doc_id") -> None:
    """Whole rows as Parquet, one folder ``_shard=i`` a shard; rows are not shuffled."""
    docs.withColumn("_shard", rendezvous(F.col(key), weights)).write.partitionBy("_shard").parquet(path)


@query("op4_rendezvous_shards")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in shards 0 to 15 under the key law, and the shard with one shard more."""
    out = assign_shards(read(spark, folder, "documents"), [1.0] * 16, grown=[1.0] * 17)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
