"""Landing files: CSV, JSON and Parquet, time folders, incremental loads."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import Contract

SOURCE_FILE = "_source_file"
SOURCE_MTIME = "_source_mtime"

_DIRECTIVES = {"%Y": ("year", 4), "%m": ("month", 2), "%d": ("day", 2), "%H": ("hour", 2)}


def text_schema(contract: Contract) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in contract.fields])


def read_landing(spark: SparkSession, contract: Contract, paths: str | Sequence[str], *,
                 schema: T.StructType | None = None) -> DataFrame:
    """Files of a contract with ``_source_file`` and ``_source_mtime``.

    CSV columns are bound by the names in each file's header, so files may order them differently, lack
    some or bring more (:func:`read_csv_by_name`); with an explicit ``schema``, or without a header, by position.
    JSON is read with an explicit all-string schema: one pass, no inference.
    JSON is by default an array (or object) per file, which one task reads; JSON lines
    (``multiLine=false``) are splittable and should be used for large files.
    """
    source = contract.source
    reader = spark.read.option("recursiveFileLookup", "true")
    paths = [paths] if isinstance(paths, str) else list(paths)
    if source.format == "csv":
        options = {"header": "true", "mode": "PERMISSIVE", **source.options}
        if schema is None and str(options["header"]).lower() == "true":
            df = read_csv_by_name(spark, paths, options, contract.field_names)
        else:
            df = reader.schema(schema or text_schema(contract)).options(**options).csv(paths)
    elif source.format == "json":
        options = {"multiLine": "true", **source.options}
        df = reader.schema(schema or text_schema(contract)).options(**options).json(paths)
    elif source.format == "parquet":
        df = reader.options(**source.options).parquet(*paths)
    else:
        raise ValueError(f"{contract.name}: not a landing format: {source.format}")
    return _with_file(df)


def _with_file(df: DataFrame) -> DataFrame:
    if SOURCE_FILE in df.columns:
        return df
    return df.withColumns({
        SOURCE_FILE: F.col("_metadata.file_path"),
        SOURCE_MTIME: F.col("_metadata.file_modification_time"),
    })


def csv_headers(spark: SparkSession, paths: Sequence[str], options: dict[str, str]) -> dict[tuple[str, ...], list[str]]:
    """Column names of the CSV files below ``paths``, each with its files; a Spark job reads the first blocks."""
    lines = spark.read.option("recursiveFileLookup", "true").text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at")).where("block = 0 and value <> ''")
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).collect():
        line = row["line"].lstrip("\ufeff")
        names = next(csv.reader([line], delimiter=options.get("sep", options.get("delimiter", ",")), quotechar=options.get("quote", '"')))
        found.setdefault(tuple(n.strip() for n in names), []).extend(row["files"])
    return found


def read_csv_by_name(spark: SparkSession, paths: Sequence[str], options: dict[str, str], declared: Sequence[str]) -> DataFrame:
    """CSV files whose columns are bound by name, all text. Names that differ from a declared one in case only become it.

    Files are grouped by header and each group is read with its own schema; columns that a group lacks are NULL.
    Without any file, or with empty ones only, the result has the declared columns and no rows.
    """
    known = {n.lower(): n for n in declared}
    parts = []
    for names, files in sorted(csv_headers(spark, paths, options).items()):
        names = [known.get(n.lower(), n) for n in names]
        if len({n.lower() for n in names}) < len(names):
            raise ValueError(f"a column name twice in the header {names} of {files[0]}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        parts.append(_with_file(spark.read.schema(schema).options(**options).csv(files)))
    if not parts:
        none = ", ".join(f"`{n}` string" for n in declared)
        return spark.createDataFrame([], f"{none}, {SOURCE_FILE} string, {SOURCE_MTIME} timestamp")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_csv_by_header(spark: SparkSession, path: str) -> DataFrame:
    """CSV with whatever columns its header names, all strings (schemas that may grow)."""
    return spark.read.option("header", "true").option("recursiveFileLookup", "true").option(
        "inferSchema", "false").csv(path)


def folder_globs(root: str, pattern: str, start: datetime, end: datetime) -> list[str]:
    """Folders of a strftime pattern between two moments, both included."""
    step = timedelta(hours=1) if "%H" in pattern else timedelta(days=1)
    moment = start.replace(minute=0, second=0, microsecond=0)
    if "%H" not in pattern:
        moment = moment.replace(hour=0)
    out = []
    while moment <= end:
        out.append(f"{root.rstrip('/')}/{moment.strftime(pattern)}")
        moment += step
    return out


def folder_columns(pattern: str, path: Column) -> dict[str, Column]:
    """Year, month, day and hour from the folder names in a file path."""
    regex = re.escape(pattern)
    order = sorted((regex.index(re.escape(d)), d) for d in _DIRECTIVES if re.escape(d) in regex)
    for d, (_, width) in _DIRECTIVES.items():
        regex = regex.replace(re.escape(d), rf"(\d{{{width}}})")
    return {
        _DIRECTIVES[d][0]: F.regexp_extract(path, regex, i).try_cast("int")
        for i, (_, d) in enumerate(order, start=1)
    }


def existing(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist, so that an empty hour is not an error."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def _by_header(contract: Contract) -> bool:
    options = {"header": "true", **contract.source.options}
    return contract.source.format == "csv" and all(
        str(options.get(k, d)).lower() == d for k, d in (("header", "true"), ("multiLine", "false")))


def stream_landing(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    """The files below a path as a stream that takes each once, whenever it lands and whatever its time says.

    What has been taken is known to the checkpoint of the query, not to the driver of a run. A landed file must not change. CSV
    files that are bound by header come as lines, see :func:`landed_rows`; other CSV files by position.
    """
    source = contract.source
    # A file that is older than the newest one by this much would be left out; nothing should be.
    reader = spark.readStream.option("recursiveFileLookup", "true").option("maxFileAge", source.options.get("maxFileAge", "36500d"))
    options = {k: v for k, v in source.options.items() if k != "maxFileAge"}
    if _by_header(contract):
        limits = {k: v for k, v in options.items() if k.startswith("maxFiles") or k == "lineSep"}
        lines = reader.options(**limits).format("text").load(path)
        return lines.select("value", F.col("_metadata.file_block_start").alias("_block"), *_file_columns())
    if source.format == "csv":
        df = reader.schema(text_schema(contract)).options(**{"header": "true", "enforceSchema": "false", **options}).csv(path)
    elif source.format == "json":
        df = reader.schema(text_schema(contract)).options(**{"multiLine": "true", **options}).json(path)
    elif source.format == "parquet":
        df = reader.schema(spark.read.option("recursiveFileLookup", "true").parquet(path).schema).options(**options).parquet(path)
    else:
        raise ValueError(f"{contract.name}: not a landing format: {source.format}")
    return df.select("*", *_file_columns())


def _file_columns() -> list[Column]:
    return [F.col("_metadata.file_path").alias(SOURCE_FILE), F.col("_metadata.file_modification_time").alias(SOURCE_MTIME)]


def landed_rows(contract: Contract, batch: DataFrame) -> DataFrame:
    """Rows of a micro-batch of :func:`stream_landing`.

    Lines of CSV files are bound by the header of their file. The distinct headers are collected, the files are not: a line
    finds its header by a join on the file.
    """
    if not _by_header(contract):
        return batch
    options = {"mode": "PERMISSIVE", **{k: v for k, v in contract.source.options.items() if k not in ("header", "maxFileAge")}}
    lines = batch.withColumn("_at", F.monotonically_increasing_id()).where(F.trim("value") != "")
    heads = lines.where("_block = 0").groupBy(SOURCE_FILE).agg(F.min_by("value", "_at").alias("_head"))
    known = {n.lower(): n for n in contract.field_names}
    headers = sorted(r["_head"] for r in heads.select("_head").distinct().collect())
    joined = lines.join(heads, SOURCE_FILE).where((F.col("_block") > 0) | (F.col("value") != F.col("_head")))
    parts = []
    for head in headers:
        found = next(csv.reader([head.lstrip("\ufeff")], delimiter=options.get("sep", options.get("delimiter", ",")), quotechar=options.get("quote", '"')))
        names = [known.get(n.strip().lower(), n.strip()) for n in found]
        if len({n.lower() for n in names}) < len(names):
            raise ValueError(f"a column name twice in the header {names}")
        schema = ", ".join(f"`{n}` string" for n in names)
        row = F.from_csv("value", F.lit(schema), options)
        parts.append(joined.where(F.col("_head") == head).select(row.alias("_row"), SOURCE_FILE, SOURCE_MTIME).select(
            "_row.*", SOURCE_FILE, SOURCE_MTIME))
    if not parts:
        return no_rows(batch.sparkSession, contract)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def no_rows(spark: SparkSession, contract: Contract) -> DataFrame:
    none = ", ".join(f"`{n}` string" for n in contract.field_names)
    return spark.createDataFrame([], f"{none}, {SOURCE_FILE} string, {SOURCE_MTIME} timestamp")


def with_folder_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """``_year``, ``_month``, ``_day`` and ``_hour`` of the time folders that a row's file lies in, as far as the contract has them."""
    parts = folder_columns(contract.source.partition_format, F.col(SOURCE_FILE))
    return df.withColumns({f"_{n}": c for n, c in parts.items()})


def read_window(spark: SparkSession, contract: Contract, path: str, start: datetime, end: datetime) -> DataFrame:
    """Landing rows of the time folders between two moments; other folders are not even listed."""
    if not contract.source.partition_format:
        raise ValueError(f"{contract.name} has no time folders")
    paths = existing(spark, folder_globs(path, contract.source.partition_format, start, end))
    return read_landing(spark, contract, paths) if paths else no_rows(spark, contract)
