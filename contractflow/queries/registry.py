"""Named queries over the given tables, each with an independent SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_settings
from ..sources.snapshots import read_parquet_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Lake:
    """The tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return read_parquet_utc(self.spark, f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of a :class:`Lake`, and the SQL that must give the same rows."""

    def register(build: Callable[[Lake], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Lake(apply_settings(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
