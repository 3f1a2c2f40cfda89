"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. Every one is a plain Spark SQL option.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even when the result feeds another operator on the
    # same key: one more exchange is cheaper than one task with a third of all rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # In Spark 4.1 a union of inputs that share a hash partitioning is taken to have it
    # too, but adaptive coalescing may merge the partitions of each input differently.
    # An aggregate or window right above then misses rows of the same key.
    "spark.sql.unionOutputPartitioning": "false",
}


def build_session(app: str = "contractflow", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``master`` is only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    The folder is read from ``spark.checkpoint.dir``. Only where that is unset, as
    on a developer machine, a temporary folder is created and set for the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="contractflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    return os.path.join(base, "contractflow", purpose, uuid.uuid4().hex)


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame below the shared scratch folder and read it back.

    Cuts the lineage of a result that several later steps use. The files outlive a
    lost executor, and like checkpoint files they are left to the platform to expire.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
