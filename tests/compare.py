"""Run a registered query and its SQL twin on the same files and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "asDict"):
        return tuple(sorted((k, _plain(v)) for k, v in value.asDict().items()))
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and a SQL result; empty when they are equal."""
    spark_rows = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    sql_rows = rows_of(names, cursor.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(spark_rows) != len(sql_rows):
        problems.append(f"{len(spark_rows)} rows != {len(sql_rows)} rows")
    for a, b in zip(spark_rows, sql_rows):
        if a != b:
            problems.append(f"{dict(zip(sorted(names), a))} != {dict(zip(sorted(names), b))}")
            break
    for i, (a, b) in enumerate(zip(spark_rows[0] if spark_rows else (), sql_rows[0] if sql_rows else ())):
        if type(a) is not type(b) and a is not None and b is not None:
            problems.append(f"{sorted(names)[i]}: {type(a).__name__} != {type(b).__name__}")
    return problems
