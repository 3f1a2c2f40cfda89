"""The run log: one row per contract run."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import service_levels
from .tables import Tables

# The columns of the run log.
RUN_LOG_SCHEMA = (
    "pipeline_run_id string, run_id string, timestamp string, start_time string, end_time string, "
    "run_duration_seconds double, engine string, contract string, contract_version string, stage string, "
    "dataset string, domain string, system string, environment string, data_layer string, status string, "
    "error_message string, source_path string, counts_source bigint, counts_total bigint, counts_good bigint, "
    "counts_quarantined bigint, quarantine_ratio double, estimated_cost double, cost_currency string, "
    "cost_confidence string, max_source_mtime double, max_watermark_value string, dlt_state_json string, "
    "slo_json string, report_json string"
)
RUN_LOG_COLUMNS = [part.split()[0] for part in RUN_LOG_SCHEMA.split(", ")]
RUN_LOG_TABLE = "_run_log"


def new_run_id() -> str:
    return uuid.uuid4().hex


def append_run(tables: Tables, levels: Mapping[tuple[str, str], service_levels.Levels] | None = None, **values) -> None:
    """Add one row; unnamed columns stay NULL. Cost follows from duration and layer, ``slo_json`` from the levels of the row's domain and layer."""
    unknown = set(values) - set(RUN_LOG_COLUMNS)
    if unknown:
        raise ValueError(f"not run log columns: {sorted(unknown)}")
    values.setdefault("engine", "spark")
    values.setdefault("timestamp", datetime.now(timezone.utc).isoformat())
    row = tables.spark.createDataFrame([tuple(values.get(c) for c in RUN_LOG_COLUMNS)], RUN_LOG_SCHEMA)
    row = service_levels.with_cost(row)
    if levels:
        row = row.withColumn("slo_json", F.to_json(service_levels.run_checks(levels)))
    tables.append(RUN_LOG_TABLE, row.coalesce(1))


def run_log(tables: Tables) -> DataFrame:
    return tables.read(RUN_LOG_TABLE)


def typed_run_log(log: DataFrame) -> DataFrame:
    """The run log with real timestamps, as the service-level checks expect it."""
    return log.withColumns({c: F.col(c).try_cast("timestamp") for c in ("timestamp", "start_time", "end_time")})


def attempts(tables: Tables, contract: str, runs: Sequence[str]) -> dict[str, set[str]]:
    """The statuses that the log holds of the given runs of a contract."""
    if not runs or not tables.exists(RUN_LOG_TABLE):
        return {}
    rows = run_log(tables).filter((F.col("contract") == contract) & F.col("run_id").isin(list(runs))).select("run_id", "status").distinct()
    out: dict[str, set[str]] = {}
    for r in rows.collect():
        out.setdefault(r["run_id"], set()).add(r["status"])
    return out


def high_watermark(spark: SparkSession, tables: Tables, contract: str) -> datetime | None:
    """Newest source file time that a successful run of the contract has taken."""
    if not tables.exists(RUN_LOG_TABLE):
        return None
    newest = (
        run_log(tables).filter((F.col("contract") == contract) & (F.col("status") == "success"))
        .agg(F.max("max_source_mtime").alias("m")).first()["m"]
    )
    return None if newest is None else datetime.fromtimestamp(newest, timezone.utc)
