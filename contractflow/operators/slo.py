"""Service-level checks over run logs and tables, run cost and layer summaries.

A run log has one row per contract run. Its windows are partitioned by contract, so
the size of a group is the number of runs of one contract.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import ratio


@dataclass(frozen=True)
class RowCountSlo:
    min_rows: int = 1
    max_rows: int | None = 500_000
    warn_only: bool = False


@dataclass(frozen=True)
class AnomalySlo:
    lookback_runs: int = 14
    min_ratio: float = 0.5
    max_ratio: float = 2.0
    min_runs: int = 5


# The least share of good rows by severity.
GOOD_RATIO_BY_SEVERITY = {"critical": 0.999, "high": 0.99, "medium": 0.95, "low": 0.9}


@dataclass(frozen=True)
class QualitySlo:
    min_good_ratio: float = 0.92
    max_quarantine_ratio: float = 0.08
    by_severity: Mapping[str, float] = field(default_factory=lambda: dict(GOOD_RATIO_BY_SEVERITY))


@dataclass(frozen=True)
class ScheduleSlo:
    expected_start: str = "04:00"
    expected_completion: str = "05:00"
    expected_minutes: float = 30
    warn_minutes: float = 60


@dataclass(frozen=True)
class LayerRate:
    per_node_hour: float
    nodes: float


# Compute rates per node hour, and nodes by the scaling assumption of the layer.
LAYER_RATES = {
    "bronze": LayerRate(0.15, 1.0),  # least of 1-4
    "silver": LayerRate(0.22, 5.0),  # average of 2-8
    "gold": LayerRate(0.55, 12.25),  # 75th percentile of 1-16
}


@dataclass(frozen=True)
class Budget:
    daily: float = 40.0
    weekly: float = 200.0
    monthly: float = 600.0
    run_multiplier: float = 3.0


def freshness(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], as_of: Column, max_delay_minutes: int) -> DataFrame:
    """Age of the newest row per table, by the first of its candidate columns that exists.

    A table without rows or without any candidate column is not fresh.
    """
    parts = []
    for name, (df, candidates) in tables.items():
        column = next((c for c in candidates if c in df.columns), None)
        newest = F.max(column) if column else F.max(F.lit(None).cast("timestamp"))
        parts.append(df.agg(
            F.lit(name).alias("table_name"),
            F.lit(column).cast("string").alias("check_column"),
            newest.cast("timestamp").alias("latest"),
        ))
    delay = F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros("latest")) / 60_000_000).cast("long")
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("delay_minutes", delay)
        .withColumn("passed", F.coalesce(F.col("delay_minutes") <= max_delay_minutes, F.lit(False)))
    )


def row_count(runs: DataFrame, slo: RowCountSlo, count: str = "counts_good") -> DataFrame:
    """Status ok / warn / fail per run from the least and greatest row count."""
    inside = F.col(count) >= slo.min_rows
    if slo.max_rows is not None:
        inside = inside & (F.col(count) <= slo.max_rows)
    status = F.when(inside, "ok").otherwise("warn" if slo.warn_only else "fail")
    return runs.withColumn("row_count_status", status)


def row_count_anomaly(runs: DataFrame, slo: AnomalySlo, *, by: str = "contract", order: Sequence[str] = ("start_time",),
                      count: str = "counts_good") -> DataFrame:
    """Compare each run with the median of the runs before it."""
    window = Window.partitionBy(by).orderBy(*order).rowsBetween(-slo.lookback_runs, -1)
    out = runs.withColumn("runs_before", F.count(F.lit(1)).over(window)).withColumn(
        "median_before", F.percentile(count, 0.5).over(window)
    )
    out = out.withColumn("row_ratio", ratio(F.col(count), F.col("median_before")))
    enforced = F.col("runs_before") >= slo.min_runs
    outside = ~F.col("row_ratio").between(slo.min_ratio, slo.max_ratio)
    return out.withColumn("anomaly", enforced & F.coalesce(outside, F.lit(False)))


def quality_gate(runs: DataFrame, slo: QualitySlo, severity: str | None = "severity") -> DataFrame:
    """Pass or fail per run from its shares of good and quarantined rows."""
    everything = F.col("counts_good") + F.col("counts_quarantined")
    out = runs.withColumn("good_ratio", ratio(F.col("counts_good"), everything)).withColumn(
        "quarantine_ratio", ratio(F.col("counts_quarantined"), everything)
    )
    least = F.lit(slo.min_good_ratio)
    if severity and severity in runs.columns:
        chain = reduce(lambda acc, kv: acc.when(F.col(severity) == kv[0], F.lit(kv[1])),
                       list(slo.by_severity.items())[1:],
                       F.when(F.col(severity) == next(iter(slo.by_severity)), F.lit(next(iter(slo.by_severity.values())))))
        least = F.coalesce(chain, least)
    out = out.withColumn("required_good_ratio", least)
    passed = (F.col("good_ratio") >= F.col("required_good_ratio")) & (
        F.col("quarantine_ratio") <= slo.max_quarantine_ratio
    )
    return out.withColumn("passed", F.coalesce(passed, F.lit(True)))


def schedule(runs: DataFrame, slo: ScheduleSlo) -> DataFrame:
    """Whether runs started, ended and took as long as planned.

    A run belongs to the planned start that is nearest to its own, so one planned for 23:50 that starts at 00:10 is late by
    twenty minutes, and one that starts some minutes early is not late by a day.
    """

    def on_day_of(moment: Column, text: str, days: int = 0) -> Column:
        hours, minutes = (int(x) for x in text.split(":"))
        return F.date_trunc("day", moment) + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes))

    start, half = F.col("start_time"), F.expr("INTERVAL 12 HOURS")
    same_day = on_day_of(start, slo.expected_start)
    planned_start = (
        F.when(start > same_day + half, on_day_of(start, slo.expected_start, 1))
        .when(start < same_day - half, on_day_of(start, slo.expected_start, -1)).otherwise(same_day)
    )
    planned_end = on_day_of(planned_start, slo.expected_completion, int(slo.expected_completion < slo.expected_start))
    taken = (F.unix_micros("end_time") - F.unix_micros("start_time")) / 60_000_000.0
    return (
        runs.withColumn("duration_minutes", taken)
        .withColumn("started_late", F.date_trunc("minute", "start_time") > planned_start)
        .withColumn("finished_late", F.date_trunc("minute", "end_time") > planned_end)
        .withColumn("over_expected", F.col("duration_minutes") > slo.expected_minutes)
        .withColumn("over_warning", F.col("duration_minutes") > slo.warn_minutes)
    )


def run_cost(runs: DataFrame, rates: Mapping[str, LayerRate] | None = None) -> DataFrame:
    """Cost of each run: hours x nodes x rate of its layer."""
    rates = rates or LAYER_RATES
    pairs = [(k, r.per_node_hour * r.nodes) for k, r in rates.items()]
    rate = reduce(lambda acc, p: acc.when(F.col("data_layer") == p[0], F.lit(p[1])), pairs[1:],
                  F.when(F.col("data_layer") == pairs[0][0], F.lit(pairs[0][1])))
    return runs.withColumn("estimated_cost", F.col("run_duration_seconds") / 3600.0 * rate)


def budget_report(costed: DataFrame, budget: Budget, *, scale: int = 6) -> DataFrame:
    """Cost per day, week and month against its limit, from runs with a cost."""
    limits = {"day": budget.daily, "week": budget.weekly, "month": budget.monthly}
    cost = F.col("estimated_cost").cast(f"decimal(18,{scale})")
    periods = F.explode(F.array(*[
        F.struct(F.lit(p).alias("period"), F.to_date(F.date_trunc(p, "start_time")).alias("period_start"),
                 F.lit(limit).alias("cost_limit"))
        for p, limit in limits.items()
    ]))
    return (
        costed.select(periods.alias("p"), cost.alias("c"))
        .groupBy("p.period", "p.period_start", "p.cost_limit")
        .agg(F.sum("c").cast("double").alias("cost"))
        .withColumn("over_budget", F.col("cost") > F.col("cost_limit"))
    )


def usual_cost(costed: DataFrame, *, by: str = "contract", order: Sequence[str] = ("start_time",), lookback: int = 14) -> DataFrame:
    """Add the median cost of the runs before each run."""
    window = Window.partitionBy(by).orderBy(*order).rowsBetween(-lookback, -1)
    return costed.withColumn("usual_cost", F.percentile("estimated_cost", 0.5).over(window))


def cost_anomalies(costed: DataFrame, budget: Budget, *, by: str = "contract",
                   order: Sequence[str] = ("start_time",), lookback: int = 14) -> DataFrame:
    """Runs that cost more than a multiple of the median of the runs before."""
    return usual_cost(costed, by=by, order=order, lookback=lookback).filter(
        F.col("estimated_cost") > budget.run_multiplier * F.col("usual_cost")
    )


def layer_summary(tables: Mapping[str, tuple[str, DataFrame, str | None]]) -> DataFrame:
    """Rows, columns and newest stamp per table, as one aggregate each."""
    parts = [
        df.agg(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
            (F.max(stamp) if stamp else F.max(F.lit(None).cast("timestamp"))).cast("timestamp").alias("latest"),
        )
        for name, (layer, df, stamp) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def release_report(tables: Mapping[str, DataFrame | None], required_columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Assertions on finished tables: they exist, hold a row and have the required columns."""
    spark = next(df for df in tables.values() if df is not None).sparkSession
    rows = []
    for name, df in tables.items():
        rows.append((name, "exists", df is not None))
        if df is None:
            continue
        rows.append((name, "has_rows", not df.isEmpty()))
        missing = [c for c in required_columns.get(name, ()) if c not in df.columns]
        if name in required_columns:
            rows.append((name, "has_columns", not missing))
    return spark.createDataFrame(rows, "table_name string, assertion string, passed boolean")
