"""Substring dedup: lines hashed after normalisation, the earliest kept, the rest named by their place in the text.

A unit is a line, a paragraph, or a clause: the text wrapped anew after each mark ``. ! ? , ; :`` that a blank follows and at empty lines,
so that a passage whose copies break lines elsewhere has the same units. A unit is normalised (A-Z in lower case, blanks made
one) and hashed to 128 bits. Units of fewer words than ``LEAST_WORDS`` gives are none: a clause of three words recurs by chance.
For each digest the earliest row (lowest id, nulls last; then place in the table) keeps its first unit; every other unit of that digest
is removed. Counts and minima are partly made before the shuffle, so a line that a third of all documents share costs one row a
task. The digests found more than once are joined back to their units; Spark splits a skewed side of that join.

A single short line that many documents happen to share ("Contents") is no copied passage. Removed units that follow each other
form a run, and only runs of at least ``min_run_words`` words are reported; 0 reports every repeated unit.

Cases: null and empty texts have no units; a text of copies may lose all its units; rows that repeat an id, and rows of null ids, rank
by their place in the table, each row for itself; an empty table gives no rows. Columns beside id and text are not read
and cannot clash; :func:`without_repeats` keeps them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .base import LOWER, pieces, query, read

MARK = {"line": "\n", "paragraph": "\n\n"}
LEAST_WORDS = {"line": 1, "paragraph": 1, "clause": 4}
#: Where a clause ends: behind a mark before a blank, or between two line breaks.
CLAUSE_END = re.compile(r"[.!?,;:](?=[\x20\x09-\x0D])|\n(?=\n)")
BLANK = " \t\n\x0b\x0c\r"
MIN_RUN_WORDS = 20
SIGN = 1 << 63


def parts_of(text: str, unit: str) -> Iterator[tuple[int, str]]:
    """Places and texts of the parts between ends of units."""
    at = 0
    if unit == "clause":
        for m in CLAUSE_END.finditer(text):
            yield at, text[at:m.end()]
            at = m.end()
        yield at, text[at:]
    else:
        for part in text.split(MARK[unit]):
            yield at, part
            at += len(part) + len(MARK[unit])


def text_units(text: str, unit: str = "line") -> Iterator[tuple[int, int, list[bytes]]]:
    """Start and end of each unit in code points, and its words in normal form. A clause begins and ends with a word."""
    least = LEAST_WORDS[unit]
    for at, part in parts_of(text, unit):
        found = part.encode("utf-8", "replace").translate(LOWER).split()
        if len(found) >= least:
            if unit == "clause":
                bare = part.lstrip(BLANK)
                at += len(part) - len(bare)
                part = bare.rstrip(BLANK)
            yield at, at + len(part), found


def units(docs: DataFrame, unit: str = "line", id_col: str = "doc_id", text: str = "text", row_col: str | None = None) -> DataFrame:
    """A row a unit. ``_row`` names the input row (``row_col`` if there is one), ``_again`` says that the row had the same unit before."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "_row", "unit", "start", "end", "n_words", "_h1", "_h2", "_again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_row = TaskContext.get().partitionId() << 40
        for batch in pieces(batches):
            rows = batch.column(2).to_pylist() if row_col else range(next_row, next_row + batch.num_rows)
            next_row += batch.num_rows
            out, of = [], []
            for i, (row, body) in enumerate(zip(rows, batch.column(1).to_pylist())):
                seen = set()
                for k, (start, end, found) in enumerate(text_units(body or "", unit)):
                    h = xxhash.xxh3_128_intdigest(b" ".join(found))
                    out.append((row, k, start, end, len(found), (h >> 64) - SIGN, (h & (2 * SIGN - 1)) - SIGN, h in seen))
                    of.append(i)
                    seen.add(h)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            columns = list(zip(*out)) or [[]] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types)]], names)

    return docs.select(id_col, text, *([row_col] if row_col else [])).mapInArrow(
        run, f"`{id_col}` {kind}, _row long, unit int, start long, end long, n_words long, _h1 long, _h2 long, _again boolean")


def repeated_units(docs: DataFrame, min_run_words: int = MIN_RUN_WORDS, unit: str = "line",
                   id_col: str = "doc_id", text: str = "text", row_col: str | None = None) -> DataFrame:
    """A row for each unit to remove: its document, number and place, the document that keeps it, and the words of its run."""
    rows = stage(units(docs, unit, id_col, text, row_col), "units")
    # Of two rows the one with an id comes first, then the lower id, then the place in the table.
    rank = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("_row").alias("row"))
    first = rows.groupBy("_h1", "_h2").agg(F.min(rank).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    rest = rows.join(first, ["_h1", "_h2"]).where(F.col("_again") | (F.col("_row") != F.col("_first.row")))
    run = F.col("unit") - F.row_number().over(Window.partitionBy("_row").orderBy("unit"))
    rest = rest.withColumn("_run", run)
    rest = rest.withColumn("run_words", F.sum("n_words").over(Window.partitionBy("_row", "_run")))
    return rest.where(F.col("run_words") >= min_run_words).select(
        id_col, "unit", "start", "end", "n_words", F.col("_first.id").alias("kept_in"), "run_words", "_row")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated units cut out of ``text``; what is left keeps its order. Each row loses its own units."""
    docs = stage(docs.withColumn("_dedup_row", F.monotonically_increasing_id()), "documents")
    cut = repeated_units(docs, id_col=id_col, text=text, row_col="_dedup_row", **options).groupBy(F.col("_row").alias("_dedup_row")).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cut"))
    mark = len(MARK.get(options.get("unit", "line"), ""))

    def step(a, s):
        return F.struct(F.concat(a["text"], F.substring(text, a["at"] + 1, (s["start"] - a["at"]).cast("int"))).alias("text"),
                        (s["end"] + mark).cast("int").alias("at"))

    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))
    left = F.aggregate("_cut", start, step, lambda a: F.concat(a["text"], F.substring(text, a["at"] + 1, F.char_length(text))))
    new = F.when(F.col("_cut").isNull(), F.col(text)).otherwise(left)
    names = [c for c in docs.columns if c != "_dedup_row"]
    return docs.join(cut, "_dedup_row", "left").select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in names])


SQL = r"""
WITH ends AS (
    SELECT doc_id, regexp_replace(regexp_replace(text, '([.!?,;:])([\x09-\x0D ])', '\1' || chr(1) || '\2', 'g'),
        '\n\n', chr(10) || chr(1) || chr(10), 'g') AS text FROM documents),
parts AS (
    SELECT doc_id, unnest(string_split(text, chr(1))) AS part, unnest(range(len(string_split(text, chr(1))))) AS nr FROM ends),
placed AS (
    SELECT *, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY nr) - length(part) AS place_,
        length(part) - length(ltrim(part, blanks)) AS gap_, length(trim(part, blanks)) AS size,
        list_filter(string_split_regex(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D ]+'),
                    lambda w: w <> '') AS words
    FROM parts, (SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS blanks)),
units AS (
    SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY nr) - 1 AS unit, place_ + gap_ AS start, place_ + gap_ + size AS "end",
        len(words) AS n_words, array_to_string(words, ' ') AS body
    FROM placed WHERE len(words) >= 4),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, unit) AS place, min(doc_id) OVER (PARTITION BY body) AS kept_in FROM units),
runs AS (
    SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run FROM ranked WHERE place > 1),
summed AS (SELECT *, sum(n_words) OVER (PARTITION BY doc_id, run) AS run_words FROM runs)
SELECT doc_id, CAST(unit AS INTEGER) AS unit, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end",
    CAST(n_words AS BIGINT) AS n_words, kept_in, CAST(run_words AS BIGINT) AS run_words
FROM summed WHERE run_words >= {least}
"""


@query("op1_line_dedup", SQL.replace("{least}", str(MIN_RUN_WORDS)))
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated clauses of all documents, in runs of twenty words or more, which no clean document has by chance."""
    return repeated_units(read(spark, folder, "documents"), unit="clause").drop("_row")


@query("op1_line_dedup_all", SQL.replace("{least}", "0"))
def op1_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every repeated clause of all documents, however short its run; ``run_words`` lets the caller choose."""
    return repeated_units(read(spark, folder, "documents"), min_run_words=0, unit="clause").drop("_row")
