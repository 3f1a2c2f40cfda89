"""Z-order: one sort key of several columns, so that files hold little of the span of each of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ordinal(column: str, kind: T.DataType) -> Column:
    """A number in the order of the column: of texts the first six bytes, of moments their microseconds."""
    c = F.col(column)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """The interleaved bits of the ranks of ``columns``, the first column's in front; NULL ranks lowest.

    A rank is the number of quantiles at or below the value, of ``2**bits - 1`` from one aggregate over the table, so that a column with
    an uneven spread is cut into parts with as many rows each.
    """
    numbers = {c: ordinal(c, df.schema[c].dataType) for c in columns}
    parts = 1 << bits
    at = [k / parts for k in range(1, parts)]
    found = df.agg(*[F.percentile_approx(n, at).alias(f"q{i}") for i, n in enumerate(numbers.values())]).first()
    ranks = []
    for i, number in enumerate(numbers.values()):
        cuts = F.array(*[F.lit(float(x)) for x in found[f"q{i}"] or []]).cast("array<double>")
        below = F.size(F.filter(cuts, (lambda n: lambda cut: cut <= n)(number)))
        ranks.append(F.when(number.isNull(), 0).otherwise(below))
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for place, rank in enumerate(reversed(ranks)):
            z = z + F.shiftleft(F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")), bit * len(ranks) + place)
    return z
