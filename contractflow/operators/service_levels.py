"""Service levels of all domains over the run log, in one plan.

The limits of a run follow from its domain and layer. They are literals of the plan (a map of at most some dozens of entries), so the
log is read once, whatever number of domains there are. Histories are windows over the runs of one contract.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import slo

# The currency of costs, and how sure an estimate from rates and durations is.
CURRENCY, CONFIDENCE = "GBP", "estimated"
CHECK_TYPE = "struct<check:string,status:string,observed:double,least:double,most:double>"


@dataclass(frozen=True)
class Levels:
    """What the runs of one layer of a domain are held to; what is None is not checked."""

    freshness_minutes: float | None = None
    source_delay_minutes: float | None = None
    row_count: slo.RowCountSlo | None = None
    anomaly: slo.AnomalySlo | None = None
    quality: slo.QualitySlo | None = None
    schedule: slo.ScheduleSlo | None = None
    environments: tuple[str, ...] = ()  # those with a schedule; none: all
    budget: slo.Budget | None = None


Limits = Mapping[tuple[str, str], Levels]


def _limit(levels: Limits, get: Callable[[Levels], object], kind: str = "double", key: Column | None = None) -> Column:
    """The limit of a run's domain and layer, NULL where there is none."""
    pairs = []
    for (domain, layer), level in levels.items():
        value = get(level)
        if value is not None:
            pairs += [F.lit(f"{domain}.{layer}"), F.lit(value).cast(kind)]
    if not pairs:
        return F.lit(None).cast(kind)
    return F.try_element_at(F.create_map(*pairs), F.concat_ws(".", "domain", "data_layer") if key is None else key)


def _check(name: str, observed: Column, least: Column | None = None, most: Column | None = None, broken: Column | str = "fail") -> Column:
    """One check; NULL, so that it is left out, where nothing was observed or no limit is set."""
    none = F.lit(None).cast("double")
    least, most, observed = (none if x is None else x.cast("double") for x in (least, most, observed))
    fine = F.coalesce(observed >= least, F.lit(True)) & F.coalesce(observed <= most, F.lit(True))
    status = F.when(fine, "ok").otherwise(broken)
    made = F.struct(F.lit(name).alias("check"), status.alias("status"), observed.alias("observed"), least.alias("least"), most.alias("most"))
    return F.when(observed.isNotNull() & (least.isNotNull() | most.isNotNull()), made)


def _of_day(text: str) -> int:
    hours, minutes = (int(x) for x in text.split(":"))
    return 60 * hours + minutes


def _minutes(later: Column, sooner: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(sooner)) / 60_000_000.0


def run_checks(levels: Limits) -> Column:
    """The checks that a row of the run log can be held to by itself, as an array.

    Rows, shares of good rows (of all rules, and of those of one severity), age of the newest change in the source when the run
    started, duration, and minutes past the planned start and end. A run belongs to the planned start that is nearest to its own.
    """
    start, end = (F.col(c).try_cast("timestamp") for c in ("start_time", "end_time"))
    total = F.nullif(F.col("counts_good") + F.col("counts_quarantined"), F.lit(0))
    warn_only = _limit(levels, lambda v: v.row_count and v.row_count.warn_only, "boolean")
    checks = [
        _check("row_count", F.col("counts_good"), _limit(levels, lambda v: v.row_count and v.row_count.min_rows),
               _limit(levels, lambda v: v.row_count and v.row_count.max_rows), F.when(warn_only, "warn").otherwise("fail")),
        _check("good_ratio", F.col("counts_good") / total, _limit(levels, lambda v: v.quality and v.quality.min_good_ratio)),
        _check("quarantine_ratio", F.col("counts_quarantined") / total,
               most=_limit(levels, lambda v: v.quality and v.quality.max_quarantine_ratio)),
    ]
    bad = F.from_json(F.get_json_object("report_json", "$.bad_by_severity"), "map<string,bigint>")
    for severity in sorted({s for v in levels.values() if v.quality for s in v.quality.by_severity}):
        share = 1 - F.try_element_at(bad, F.lit(severity)) / total
        checks.append(_check(f"good_ratio:{severity}", share, _limit(levels, lambda v, s=severity: v.quality and v.quality.by_severity.get(s))))
    checks.append(_check("source_delay", _minutes(start, F.col("max_watermark_value").try_cast("timestamp")),
                         most=_limit(levels, lambda v: v.source_delay_minutes)))
    checks.append(_check("duration", F.col("run_duration_seconds") / 60.0, most=_limit(levels, lambda v: v.schedule and v.schedule.warn_minutes),
                         broken="warn"))
    planned = _limit(levels, lambda v: v.schedule and _of_day(v.schedule.expected_start), "int")
    length = _limit(levels, lambda v: v.schedule and (_of_day(v.schedule.expected_completion) - _of_day(v.schedule.expected_start)) % 1440, "int")
    environments = _limit(levels, lambda v: ",".join(v.environments) if v.schedule and v.environments else None, "string")
    scheduled = F.coalesce(F.array_contains(F.split(environments, ","), F.col("environment")), environments.isNull())
    late = F.lit(720) - F.pmod(F.lit(720) - (F.hour(start) * 60 + F.minute(start) - planned), F.lit(1440))
    past_end = F.floor(_minutes(F.date_trunc("minute", end), F.date_trunc("minute", start))) + late - length
    checks.append(_check("minutes_past_start", F.when(scheduled, late), most=F.lit(0), broken="warn"))
    checks.append(_check("minutes_past_end", F.when(scheduled, past_end), most=F.lit(0)))
    return F.array_compact(F.array(*checks))


def with_cost(runs: DataFrame, rates: Mapping[str, slo.LayerRate] | None = None) -> DataFrame:
    """The cost columns of the run log from duration and layer."""
    out = slo.run_cost(runs, rates)
    return out.withColumn("cost_currency", F.when(F.col("estimated_cost").isNotNull(), CURRENCY)).withColumn(
        "cost_confidence", F.when(F.col("estimated_cost").isNotNull(), CONFIDENCE))


def _rows(df: DataFrame, check: Column, contract: Column, run: Column) -> DataFrame:
    return df.select("domain", "data_layer", contract.alias("contract"), run.alias("run_id"), check.alias("c")).where("c IS NOT NULL")


def evaluate(log: DataFrame, levels: Limits, as_of: Column) -> DataFrame:
    """Every check of every logged run, and those that need its history: (domain, data_layer, contract, run_id, check, status, observed,
    least, most).

    * ``row_anomaly``: rows against the median of the successful runs before; ``cost_anomaly`` likewise, as a multiple;
    * ``freshness``: minutes from the end of the newest successful run of a contract to ``as_of``;
    * ``cost:day``, ``cost:week``, ``cost:month``: what a domain spent in the current period.

    A check with neither an observation nor a limit gives no row.
    """
    none, run = F.lit(None).cast("string"), F.col("run_id")
    ended = F.col("end_time").try_cast("timestamp")
    begun = log.withColumn("_start", F.col("start_time").try_cast("timestamp"))
    alone = begun.select("domain", "data_layer", "contract", "run_id", F.explode(run_checks(levels)).alias("c"))
    done = begun.where("status = 'success'")
    parts = [alone]
    for anomaly in {v.anomaly for v in levels.values() if v.anomaly}:
        held = {k: v for k, v in levels.items() if v.anomaly == anomaly}
        seen = slo.row_count_anomaly(done, anomaly, order=("_start", "run_id"))
        enforced = F.when(F.col("runs_before") >= anomaly.min_runs, F.col("row_ratio"))
        parts.append(_rows(seen, _check("row_anomaly", enforced, _limit(held, lambda v: v.anomaly.min_ratio), _limit(held, lambda v: v.anomaly.max_ratio)),
                           F.col("contract"), run))
    costs = slo.usual_cost(done, order=("_start", "run_id"))
    multiple = F.col("estimated_cost") / F.nullif(F.col("usual_cost"), F.lit(0.0))
    parts.append(_rows(costs, _check("cost_anomaly", multiple, most=_limit(levels, lambda v: v.budget and v.budget.run_multiplier)), F.col("contract"), run))
    newest = done.groupBy("domain", "data_layer", "contract").agg(F.max(ended).alias("_end"))
    parts.append(_rows(newest, _check("freshness", F.floor(_minutes(as_of, F.col("_end"))), most=_limit(levels, lambda v: v.freshness_minutes)),
                       F.col("contract"), none))
    periods = {"day": "daily", "week": "weekly", "month": "monthly"}
    spent = begun.where(F.col("_start") <= as_of).groupBy("domain").agg(*[
        F.sum(F.when(F.col("_start") >= F.date_trunc(p, as_of), F.col("estimated_cost")).cast("decimal(18,6)")).cast("double").alias(p) for p in periods])
    by_domain = {(domain, ""): v for (domain, _), v in levels.items() if v.budget}
    for period, name in periods.items():
        limit = _limit(by_domain, lambda v, n=name: getattr(v.budget, n), key=F.concat(F.col("domain"), F.lit(".")))
        parts.append(_rows(spent.withColumn("data_layer", none), _check(f"cost:{period}", F.col(period), most=limit, broken="warn"), none, none))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("domain", "data_layer", "contract", "run_id", "c.*")
