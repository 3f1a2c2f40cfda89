"""Amounts in one currency, by the rates that a table of pairs implies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .asof import asof_by_time

#: How a rate came about, the better the smaller.
QUOTED, INVERSE, CROSS = 0, 1, 2


def implied_rates(rates: DataFrame, date: str, base: str, quote: str, rate: str) -> DataFrame:
    """All rates of a day that its pairs imply: as quoted, else the inverse of a quoted one, else over one currency between.

    Columns ``date``, ``base``, ``quote``, ``rate``, ``how`` and ``between`` (the currency between). Of several ways over a currency the
    one with the least name counts; a pair quoted twice on a day counts with its least rate. Rates that are NULL or not positive
    are left out. Pairs of a day are as many as the square of the currencies at most.
    """
    quoted = rates.where(F.col(rate) > 0).where(f"`{date}` IS NOT NULL AND `{base}` IS NOT NULL AND `{quote}` IS NOT NULL").groupBy(
        F.to_date(date).alias("date"), F.col(base).alias("base"), F.col(quote).alias("quote")).agg(
        F.min(F.col(rate).cast("double")).alias("rate"))
    inverse = quoted.select("date", F.col("quote").alias("base"), F.col("base").alias("quote"), (1 / F.col("rate")).alias("rate"))
    nearest = F.struct("how", "rate")
    edges = quoted.withColumn("how", F.lit(QUOTED)).unionByName(inverse.withColumn("how", F.lit(INVERSE))).groupBy(
        "date", "base", "quote").agg(F.min(nearest).alias("_best")).select("date", "base", "quote", "_best.rate", "_best.how")
    onward = edges.select("date", F.col("base").alias("between"), F.col("quote").alias("_to"), F.col("rate").alias("_rate"))
    crossed = edges.select("date", "base", F.col("quote").alias("between"), "rate").join(onward, ["date", "between"]).where(
        F.col("base") != F.col("_to")).select("date", "base", F.col("_to").alias("quote"), (F.col("rate") * F.col("_rate")).alias("rate"), "between")
    every = edges.withColumn("between", F.lit(None).cast("string")).unionByName(crossed.withColumn("how", F.lit(CROSS)))
    best = every.groupBy("date", "base", "quote").agg(F.min(F.struct("how", "between", "rate")).alias("_best"))
    return best.select("date", "base", "quote", "_best.rate", "_best.how", "_best.between")


def convert(facts: DataFrame, implied: DataFrame, timestamp: str, currency: str, amounts: Sequence[str], target: str, *,
            max_age_days: int) -> DataFrame:
    """``facts`` with ``<amount>_<target>`` by the last rate on or before the day, at most ``max_age_days`` old, and with
    ``rate_date`` and ``rate_how``; NULL where there is none. An amount in the target currency stays as it is."""
    dim = implied.where(F.col("quote") == target).select(
        "base", F.col("date").cast("timestamp").alias("effective_from"),
        F.date_add("date", max_age_days + 1).cast("timestamp").alias("effective_to"),
        F.col("date").alias("rate_date"), F.col("how").alias("rate_how"), F.col("rate").alias("_rate"))
    found = asof_by_time(facts, dim, ["base"], timestamp, ["rate_date", "rate_how", "_rate"], fact_keys=[currency])
    same = F.col(currency) == target
    factor = F.when(same, F.lit(1.0)).otherwise(F.col("_rate"))
    out = {f"{a}_{target.lower()}": F.col(a) * factor for a in amounts}
    return found.withColumns({
        **out, "rate_date": F.when(~same, F.col("rate_date")), "rate_how": F.when(~same, F.col("rate_how"))}).drop("_rate")
