"""Calendar attributes and ISO-8601 periods."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """Numeric yyyymmdd key of a date."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(d: Column) -> dict[str, Column]:
    """The attributes of a date dimension row (ISO weekday: Monday is 1)."""
    weekday = F.weekday(d) + 1
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "day": F.dayofmonth(d),
        "day_of_week": weekday,
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": weekday >= 6,
        "iso_week": F.weekofyear(d),
    }


_PERIOD = re.compile(r"P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?$")


def parse_period(text: str) -> tuple[int, int]:
    """(months, days) of an ISO-8601 period such as ``P7D`` or ``P7Y``."""
    found = _PERIOD.match(text)
    if not found or text == "P":
        raise ValueError(f"not a period: {text!r}")
    years, months, weeks, days = (int(g or 0) for g in found.groups())
    return years * 12 + months, weeks * 7 + days


def older_than(c: Column, period: str, as_of: Column) -> Column:
    """Whether a timestamp lies more than ``period`` before ``as_of``."""
    months, days = parse_period(period)
    cutoff = as_of - F.make_interval(months=F.lit(months), days=F.lit(days))
    return c < cutoff
