"""Parquet tables below one root folder.

Spark cannot overwrite files that the same job reads. A full rewrite therefore goes
to a new version folder, and a one-line pointer file is switched after the write has
succeeded; a failed or repeated job leaves the old version in place. Appends and
rewrites of single partitions happen inside the current version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_composite
from ..operators.merge import merge_upsert
from ..operators.zorder import z_value
from .claims import LEASE, WRITER, Claims

_POINTER = "_current"


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.claims = Claims(spark, self.root)

    def writer(self, name: str):
        """Held by the one run that may make, widen or rewrite a table; plain appends need no claim."""
        return self.claims.held(name, WRITER, wait=2 * LEASE)

    # -- pointer -------------------------------------------------------------

    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _current(self, name: str) -> dict | None:
        fs, pointer = self._fs(f"{self.root}/{name}/{_POINTER}")
        if not fs.exists(pointer):
            return None
        stream = fs.open(pointer)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _switch(self, name: str, version: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
        fs, pointer = self._fs(f"{self.root}/{name}/{_POINTER}")
        content = {"version": version, "schema": schema.jsonValue(), "partition_by": list(partition_by)}
        # Written beside the pointer and renamed over it: a reader finds the old text or the new one.
        jvm = self.spark._jvm
        _, beside = self._fs(f"{self.root}/{name}/{_POINTER}-{uuid.uuid4().hex}")
        stream = fs.create(beside, True)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), self.spark._jsc.hadoopConfiguration())
        rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename").OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 1)
        options[0] = rename
        context.rename(beside, pointer, options)

    def _known(self, name: str) -> dict:
        current = self._current(name)
        if current is None:
            raise FileNotFoundError(f"no table {name} below {self.root}")
        return current

    def path(self, name: str) -> str:
        return f"{self.root}/{name}/{self._known(name)['version']}"

    def partition_columns(self, name: str) -> list[str]:
        return self._known(name)["partition_by"]

    # -- reads ---------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self._current(name) is not None

    def read(self, name: str) -> DataFrame:
        """The current version, read with its recorded schema: no file is opened to infer one."""
        current = self._known(name)
        schema = T.StructType.fromJson(current["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{current['version']}")

    # -- writes --------------------------------------------------------------

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Write a new version and make it current. ``df`` may read the old one."""
        version = f"v-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{self.root}/{name}/{version}")
        self._switch(name, version, df.schema, partition_by)

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Add rows. New columns widen the schema; older files give NULL for them."""
        current = self._current(name)
        if current is None:
            with self.writer(name):
                current = self._current(name)  # two runs may have found no table
                if current is None:
                    self.replace(name, df, partition_by)
                    return
        schema = T.StructType.fromJson(current["schema"])
        known = {f.name: f.dataType for f in schema.fields}
        aligned = df.select(*[F.col(c).cast(known[c]).alias(c) if c in known else F.col(c) for c in df.columns])
        aligned.write.mode("append").partitionBy(*current["partition_by"]).parquet(
            f"{self.root}/{name}/{current['version']}")
        new = [f for f in df.schema.fields if f.name not in known]
        if new:
            with self.writer(name):
                latest = self._known(name)
                fields = T.StructType.fromJson(latest["schema"]).fields
                fields += [f for f in new if f.name not in {g.name for g in fields}]
                self._switch(name, latest["version"], T.StructType(fields), latest["partition_by"])

    def merge(self, name: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str] = (),
              evolution: str = "append") -> None:
        """Upsert by key. On a partitioned table only the touched partitions are rewritten.

        Touched are the partitions of the source rows and those that hold the old rows of
        the same keys. They are found from the key and partition columns alone. A partition
        that would end up empty cannot be overwritten with rows, so then, and for tables
        without partitions, a whole new version is written.
        """
        current = self._current(name)
        if current is None:
            self.replace(name, merge_upsert(source.limit(0), source, keys), partition_by)
            return
        target, parts = self.read(name), current["partition_by"]
        new_columns = set(source.columns) - set(target.columns)
        if parts and not new_columns:
            incoming = source.select(*parts).distinct()
            if set(parts) <= set(keys):
                touched = incoming  # a row cannot change its partition
                emptied = None
            else:
                ids = target.select(*dict.fromkeys([*keys, *parts]))
                fresh = source.select(*keys).distinct()
                old = join_composite(ids, fresh, keys, "left_semi", null_safe=True).select(*parts)
                rest = join_composite(ids, fresh, keys, "left_anti", null_safe=True).select(*parts)
                touched, kept = old.unionByName(incoming).distinct(), rest.unionByName(incoming).distinct()
                emptied = join_composite(touched, kept, parts, "left_anti", null_safe=True)
            if emptied is None or emptied.isEmpty():
                part_rows = self._in_partitions(target, touched, parts)
                self.overwrite_partitions(name, merge_upsert(part_rows, source, keys, evolution=evolution))
                return
        self.replace(name, merge_upsert(target, source, keys, evolution=evolution), parts)

    def _in_partitions(self, df: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
        """Rows of the given partitions, NULL partitions included."""
        return join_composite(df, touched, parts, "left_semi", null_safe=True)

    def overwrite_partitions(self, name: str, df: DataFrame) -> None:
        """Replace just the partitions that ``df`` holds. ``df`` may read them."""
        current = self._known(name)
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*current["partition_by"]).parquet(f"{self.root}/{name}/{current['version']}"))

    def forget_runs(self, name: str, column: str, runs: Sequence[str]) -> None:
        """Drop the rows of the given runs, as what a broken run left behind.

        An append writes files of one run, and files say in their footers which runs they hold, so few are opened. Files of
        these runs alone are deleted, which leaves what other runs add at the same time untouched; only where they share a
        file with others, as after compaction, the table is written anew.
        """
        if not runs or not self.exists(name) or column not in (df := self.read(name)).columns:
            return
        file = F.col("_metadata.file_path")
        held = df.filter(F.col(column).isin(list(runs))).select(file.alias("file")).distinct()
        files = [r["file"] for r in held.collect()]
        if not files:
            return
        mine = F.coalesce(F.col(column).isin(list(runs)), F.lit(False))
        touched = df.withColumn("_file", file).filter(F.col("_file").isin(files))
        if touched.filter(~mine).isEmpty():
            for f in files:
                fs, path = self._fs(f)
                fs.delete(path, False)
        else:
            with self.writer(name):
                whole = self.read(name)
                self.replace(name, whole.filter(~mine), self.partition_columns(name))

    # -- resets --------------------------------------------------------------

    def create_empty(self, name: str, schema, partition_by: Sequence[str] = ()) -> None:
        if not self.exists(name):
            self.replace(name, self.spark.createDataFrame([], schema), partition_by)

    def truncate(self, name: str) -> None:
        """Reload: keep the schema, drop the rows."""
        self.replace(name, self.read(name).limit(0), self._known(name)["partition_by"])

    def drop(self, name: str) -> None:
        """Reset: forget the table. Files stay for the housekeeping of the platform."""
        fs, pointer = self._fs(f"{self.root}/{name}/{_POINTER}")
        fs.delete(pointer, False)

    def compact(self, name: str, target_files: int, cluster_by: Sequence[str] = (), zorder_by: Sequence[str] = ()) -> None:
        """Rewrite into fewer files, sorted by the columns that queries filter on.

        ``cluster_by`` sorts by one column after the other, so files hold a narrow span of the first; with ``zorder_by`` they hold a
        narrow span of each column, so that a filter on any of them skips files. Range partitioning splits by sampled values, so a
        frequent value of the first column is spread by the next ones. A partitioned table is clustered by its
        partition columns first, so that each task writes few files.
        """
        if cluster_by and zorder_by:
            raise ValueError("cluster by columns or by their z-order, not both")
        with self.writer(name):
            df, parts = self.read(name), self._known(name)["partition_by"]
            columns = df.columns
            order = [*parts, *cluster_by]
            if zorder_by:
                df, order = df.withColumn("_z", z_value(df, zorder_by)), [*parts, "_z", *zorder_by]
            if order:
                df = df.repartitionByRange(target_files, *order).sortWithinPartitions(*order).select(*columns)
            else:
                df = df.repartition(target_files)
            self.replace(name, df, parts)
