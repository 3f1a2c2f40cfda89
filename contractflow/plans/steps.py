"""SQL text as a contract transform."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..contract import Transform


def sql_step(*statements: str) -> Transform:
    """A transform that runs Spark SQL over ``source`` and the links by name.

    Several statements run in order; each result is the ``source`` of the next. The
    views are resolved when a statement is analysed, so a later step or contract may
    use the same names.
    """

    def transform(inputs: Mapping[str, DataFrame]) -> DataFrame:
        current = dict(inputs)
        for text in statements:
            for name, df in current.items():
                df.createOrReplaceTempView(name)
            current["source"] = current["source"].sparkSession.sql(text)
        return current["source"]

    return transform
