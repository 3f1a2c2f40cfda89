"""Token ids of all documents in Parquet files from which spans of tokens, single documents or the index alone can be read.

File format. ``tokens/`` holds a row a document in ascending order of ids: its id, ``part`` (number of the file), ``position`` (tokens before
it in the file), ``n_tokens`` and the list ``ids``. The id column and the list use dictionary encoding (a vocabulary fits one dictionary
page), part and position delta encoding. Row groups have a set size, and pages a set number of rows, so the page indexes that Parquet keeps of
ids and positions let a reader skip all pages but those of the documents asked for; a reader of the index opens no page of ``ids`` at all.
``parts/`` holds a row a file with its tokens, and the tokens before it: with them a place in a file is a place in the whole sequence.

Documents are dealt to files by ranges of (id, hash of the text, number of the row), so a hot id is spread over files, too; texts become ids
as the sorted rows of a file stream by. Files are written by Spark below a folder that all executors share.

Cases: a null or empty text is the end id alone; null ids come first; rows that share an id are kept in order of the hash of the text, and
equal rows in any order; an empty table gives empty folders that read as no rows. Columns beside id and text are not read and cannot clash.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .base import pieces, query, read, utf8
from .packing import STEP, digests, tokenizer_path, word_tokens

#: UTF-8 bytes of text to a file, bytes of a row group, rows and bytes of a page.
FILE_BYTES, GROUP_BYTES, PAGE_ROWS, PAGE_BYTES = 64 << 20, 16 << 20, 256, 1 << 18


def encoded(docs: DataFrame, id_col: str, text: str, path: str | None, end_id: int) -> DataFrame:
    """Rows of a file in their order: id, part, position, n_tokens and ids."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = word_tokens(path or tokenizer_path()), array("I", [end_id]).tobytes()
        part, position = TaskContext.get().partitionId(), 0
        for batch in pieces(batches, STEP):
            bodies = [ids + end for ids in tokens(utf8(batch.column(1)))]
            ends = np.cumsum([0, *(len(b) // 4 for b in bodies)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(bodies), np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(batch.num_rows, part), pa.int32()), pa.array(position + ends[:-1], pa.int64()),
                 pa.array(np.diff(ends), pa.int64()), ids], [id_col, "part", "position", "n_tokens", "ids"])
            position += int(ends[-1])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, part int, position long, n_tokens long, ids array<int>")


def in_order(docs: DataFrame, id_col: str, text: str, file_bytes: int) -> DataFrame:
    """Ids and texts in one order over all partitions, each of about ``file_bytes`` bytes of text."""
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    first = F.col(id_col).asc_nulls_first()
    keyed = docs.select(id_col, text).withColumns({"_hash": F.xxhash64(text), "_copy": F.monotonically_increasing_id()})
    dealt = keyed.repartitionByRange(max(1, math.ceil(size / file_bytes)), first, "_hash", "_copy")
    return dealt.sortWithinPartitions(first, "_hash", text)


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = 2,
                 file_bytes: int = FILE_BYTES, group_bytes: int = GROUP_BYTES, page_rows: int = PAGE_ROWS,
                 page_bytes: int = PAGE_BYTES) -> None:
    """Write all documents below ``folder``, which must not exist yet. The tokenizer is the file at ``path``."""
    rows = encoded(in_order(docs, id_col, text, file_bytes), id_col, text, path, end_id)
    writer = rows.write.options(**{
        "compression": "zstd", "parquet.writer.version": "v2", "parquet.block.size": group_bytes, "parquet.page.size": page_bytes,
        "parquet.page.row.count.limit": page_rows, "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#part": "false", "parquet.enable.dictionary#position": "false"})
    writer.parquet(f"{folder}/tokens")
    # One row a file: even at petabytes this is a small table.
    files = stored(docs.sparkSession, folder).groupBy("part").agg(F.count("*").alias("n_rows"), F.sum("n_tokens").alias("n_tokens"))
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files.withColumn("start", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{folder}/parts")


def stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/tokens")


def placed(rows: DataFrame, folder: str) -> DataFrame:
    """Stored rows with ``start``, the tokens of all documents before, in place of part and position."""
    files = rows.sparkSession.read.parquet(f"{folder}/parts").select("part", F.col("start").alias("_start"))
    start = (F.col("_start") + F.col("position")).alias("start")
    names = [c for c in rows.columns if c not in ("part", "position")]
    return rows.join(files, "part").select(names[0], start, *names[1:])


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Id, ``start`` and ``n_tokens`` of all documents; no page of ids is read."""
    return placed(stored(spark, folder).drop("ids"), folder)


def read_tokens(spark: SparkSession, folder: str, where: Column | None = None) -> DataFrame:
    """Id, ``start``, ``n_tokens`` and ``ids`` of the documents that meet ``where``, a condition on the id column or ``n_tokens``;
    Spark compares it with the indexes of row groups and pages before it reads."""
    rows = stored(spark, folder)
    return placed(rows if where is None else rows.where(where), folder)


def read_span(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """The tokens at places ``first`` to ``last - 1`` of the whole sequence: a row a document, with ``start`` and ``ids`` cut to the span.

    The table of files says which parts hold the span. Only the first and the last of them need a condition on positions, which
    the page indexes answer; each is its own scan.
    """
    files = spark.read.parquet(f"{folder}/parts")
    held = files.where((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
    ends = held.agg(F.min(F.struct("part", "start")), F.max(F.struct("part", "start"))).first()
    rows = stored(spark, folder)
    if ends[0] is None or first >= last:
        return placed(rows.where("false"), folder)
    (low, low_start), (high, high_start) = ends
    reaches, starts = F.col("position") + F.col("n_tokens") > first - low_start, F.col("position") < last - high_start
    if low == high:
        found = rows.where((F.col("part") == low) & reaches & starts)
    else:
        found = rows.where((F.col("part") == low) & reaches).unionByName(rows.where((F.col("part") == high) & starts))
        if high > low + 1:
            found = found.unionByName(rows.where((F.col("part") > low) & (F.col("part") < high)))
    found = placed(found, folder)
    cut = F.greatest(F.lit(0), first - F.col("start"))
    ids = F.slice("ids", (cut + 1).cast("int"), (F.least(F.col("n_tokens"), last - F.col("start")) - cut).cast("int"))
    return found.select(found.columns[0], (F.col("start") + cut).alias("start"), ids.alias("ids"))


@query("op12_token_files")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written as files of token ids and read back: where each starts, its length and the checksum of its ids."""
    files = scratch_path(spark, "token_files")
    write_tokens(read(spark, folder, "documents"), files)
    return digests(read_tokens(spark, files))
