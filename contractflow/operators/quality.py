"""Row rules, the good/bad split, dataset rules and quarantine inspection."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import Rule
from .schema import Check

ERRORS = "_errors"
ERROR_TYPE = "array<struct<rule:string,category:string>>"


def rule_check(rule: Rule) -> Check:
    return Check(rule.name, rule.category, F.expr(rule.sql))


def not_null(column: str) -> Rule:
    """Shorthand for a rule that a column must be filled."""
    return Rule(f"not_null:{column}", f"{column} IS NOT NULL", "completeness")


def annotate(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """Add ``_errors``: all failed rules of a row, found in one pass.

    A rule that evaluates to NULL has failed; rules that accept NULL say so.
    """
    entries = [
        F.when(~F.coalesce(c.passes, F.lit(False)),
               F.struct(F.lit(c.rule).alias("rule"), F.lit(c.category).alias("category")))
        for c in checks
    ]
    errors = F.array_compact(F.array(*entries)) if entries else F.array().cast(ERROR_TYPE)
    return df.withColumn(ERRORS, errors)


def bad_by_severity(rules: Sequence[Rule]) -> Column:
    """An aggregate: rows that break a rule, by severity of the rules they break. Checks of the schema count as ``high``."""
    named: dict[str, list[str]] = {}
    for r in rules:
        named.setdefault(r.severity, []).append(r.name)
    others = [n for s, names in named.items() if s != "high" for n in names]
    broken = F.transform(ERRORS, lambda e: e["rule"])
    hit = {"high": F.size(F.array_except(broken, F.array(*map(F.lit, others)).cast("array<string>")))}
    hit |= {s: F.size(F.array_intersect(broken, F.array(*map(F.lit, names)))) for s, names in named.items() if s != "high"}
    return F.struct(*[F.count_if(n > 0).alias(s) for s, n in hit.items()])


def split(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without helper columns, bad rows with their errors)."""
    good = annotated.filter(F.size(ERRORS) == 0).drop(ERRORS)
    return good, annotated.filter(F.size(ERRORS) > 0)


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count. Only the key columns are shuffled."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def unique_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys repeat and how many rows are surplus."""
    bad = unique_violations(df, keys)
    return bad.agg(
        F.lit("unique:" + ",".join(keys)).alias("rule"),
        F.count(F.lit(1)).alias("violating_keys"),
        F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    ).withColumn("passed", F.col("violating_keys") == 0)


def foreign_key_orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child key values without a parent, with the number of rows that hold them.

    Keys are counted first, so the join sees one row per distinct value.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("child_rows"))
    parents = parent.select(F.col(parent_column).alias(column))
    return keys.join(parents, column, "left_anti")


# -- quarantine inspection ---------------------------------------------------


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _recent(df: DataFrame, stamp: str, within_days: int | None, as_of: Column) -> DataFrame:
    return df if within_days is None else df.filter(F.datediff(as_of, F.col(stamp)) <= within_days)


def quarantine_counts(tables: Mapping[str, DataFrame], stamp: str, as_of: Column,
                      within_days: int | None = None) -> DataFrame:
    """Rows and newest stamp per quarantined entity, largest first."""
    parts = [
        _recent(df, stamp, within_days, as_of).agg(
            F.lit(name).alias("entity"),
            F.count(F.lit(1)).alias("quarantined_rows"),
            F.max(stamp).alias("latest"),
        )
        for name, df in tables.items()
    ]
    return _union(parts).orderBy(F.desc("quarantined_rows"), "entity")


def quarantine_reasons(tables: Mapping[str, DataFrame], top: int | None = 50) -> DataFrame:
    """How often each rule rejected a row, per entity; the ``top`` most frequent."""
    parts = [
        df.select(F.lit(name).alias("entity"), F.explode(ERRORS).alias("e"))
        .groupBy("entity", F.col("e.rule").alias("rule"), F.col("e.category").alias("category"))
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
        for name, df in tables.items()
    ]
    ranked = _union(parts).orderBy(F.desc("rejected_rows"), "entity", "rule")
    return ranked if top is None else ranked.limit(top)


def quarantine_sample(df: DataFrame, rule: str | None = None, rows: int = 20) -> DataFrame:
    """A few bad rows to look at, optionally those that broke one rule."""
    if rule is not None:
        df = df.filter(F.exists(ERRORS, lambda e: e["rule"] == rule))
    return df.limit(rows)
