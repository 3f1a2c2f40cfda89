"""Benchmark decontamination by spaced seeds.

A mask names the positions of a window that count; the others may hold any token. Windows of the benchmark are hashed under
every mask, and so are all windows of the training texts. A passage in which single tokens were replaced still
agrees under some mask, where a run of equal tokens would be broken. Each hit gives a benchmark item and a shift; the two texts
are laid beside each other at that shift and compared token by token around the hit.

Training windows are not shuffled. They pass a Bloom filter of the benchmark's hashes, whose size is fixed (``FILTER_BITS``, 8 MB)
however large the benchmark is; windows that pass it by chance are removed by the exact join that follows. Around hits
the task keeps the token hashes of the neighbourhood, so texts need not be read again for the comparison.

Tokens are runs of letters and digits in lower case. Items with fewer tokens than a window are sought whole.

Cases: null and empty texts have no tokens and are neither leaks nor leaked; repeated rows are reported once an id; a
null id is an id; empty tables give no rows; columns beside id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .base import pieces, query, read
from .tokens import SYMBOLS, mix, tokenize

#: Twelve tokens, of which seven count, or nine: the last mask passes over every fourth, which no other does.
MASKS = ("110100110101", "101100101101", "111010001011", "110010110011", "111011101110")
FILTER_BITS = 26
#: Token hashes kept on both sides of a hit.
AROUND = 96
#: What a different token costs, in equal ones.
_MISMATCH = 2


def _factor(k: int) -> np.uint64:
    return mix(np.array([k + 1], np.uint64))[0] | np.uint64(1)


def seeds(hashes: np.ndarray, first: np.ndarray, masks: Sequence[str], whole: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of windows, and their hashes under each mask; ``whole`` adds full windows of other lengths."""
    length = np.diff(first)
    left = np.repeat(first[1:], length) - np.arange(len(hashes))  # tokens from here to the end of the text
    for nr, mask in enumerate([*masks, *("1" * n for n in whole)]):
        at = np.flatnonzero(left >= len(mask))
        h = np.full(len(at), mix(np.array([nr if nr < len(masks) else 1000 + len(mask)], np.uint64))[0])
        for k, c in enumerate(mask):
            if c == "1":
                h += hashes[at + k] * _factor(k)
        yield at, mix(h)


def _slots(h: np.ndarray) -> list[np.ndarray]:
    """Three places of a hash in the filter."""
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return [(h >> np.uint64(shift)) & mask for shift in (0, 20, 38)]


def passes(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Places of the hashes that the filter knows; ``bits`` are its packed bytes."""
    keep = np.arange(len(h))
    for k in range(3):
        slot = _slots(h[keep])[k]
        keep = keep[(bits[slot >> np.uint64(3)] >> (np.uint64(7) - (slot & np.uint64(7))).astype(np.uint8)) & 1 == 1]
    return keep


def benchmark_seeds(items: DataFrame, id_col: str, text: str, masks: Sequence[str]) -> DataFrame:
    """One row an item: its token hashes, and hash and position of its windows."""
    span, kind = max(map(len, masks)), items.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            t = tokenize(pc.utf8_lower(batch.column(1)), SYMBOLS)
            rows = []
            for a, b in zip(t.first[:-1], t.first[1:]):
                own, n = t.hashes[a:b], int(b - a)
                found = list(seeds(own, np.array([0, n]), masks if n >= span else [], [] if n >= span else [n] if n else []))
                h = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.uint64)
                at = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
                rows.append((own.view(np.int64).tolist(), h.view(np.int64).tolist(), at.tolist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in range(3)]],
                [id_col, "item_tokens", "h", "at"])

    return items.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, item_tokens array<long>, h array<long>, at array<long>")


def bloom(hashes: DataFrame) -> bytes:
    """A filter of the hashes in column ``h``; every task sends one of fixed size, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, any_row = np.zeros(1 << FILTER_BITS, bool), False
        for batch in batches:
            any_row = any_row or batch.num_rows > 0
            for slot in _slots(batch.column(0).to_numpy().view(np.uint64)):
                bits[slot] = True
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits).tobytes(), 1)], pa.binary())], ["b"])

    out = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in hashes.select("h").coalesce(8).mapInArrow(run, "b binary").toLocalIterator():
        out |= np.frombuffer(zlib.decompress(row["b"]), np.uint8)
    return out.tobytes()


def neighbourhoods(docs: DataFrame, packed, id_col: str, text: str, masks: Sequence[str], whole: Sequence[int]) -> DataFrame:
    """Stretches of training texts around windows that pass the filter: token hashes, and the windows."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(packed.value, np.uint8)

        for batch in pieces(batches, 256):
            t = tokenize(pc.utf8_lower(batch.column(1)), SYMBOLS)
            hits, hashes = [], []
            for at, h in seeds(t.hashes, t.first, masks, whole):
                keep = passes(h, bits)
                hits.append(at[keep])
                hashes.append(h[keep])
            at, h = np.concatenate(hits), np.concatenate(hashes)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
            doc = np.searchsorted(t.first, at, side="right") - 1
            new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(at, prepend=at[0]) > AROUND))
            low = np.maximum(t.first[doc[new]], at[new] - AROUND)
            last = np.append(new[1:], len(at)) - 1
            high = np.minimum(t.first[doc[new] + 1], at[last] + AROUND)
            split = lambda x, a, b: pa.array([x[i:j] for i, j in zip(a, b)], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(doc[new])), pa.array(low - t.first[doc[new]]),
                split(t.hashes.view(np.int64), low, high), split(h.view(np.int64), new, last + 1),
                split(at - t.first[doc], new, last + 1)], [id_col, "low", "tokens", "h", "at"])

    return docs.select(id_col, text).mapInArrow(
        run, f"`{id_col}` {kind}, low long, tokens array<long>, h array<long>, at array<long>")


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """Start, end and number of equal positions of the stretch with the most of them against ``_MISMATCH`` a difference."""
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -_MISMATCH))])
    low = np.minimum.accumulate(score)
    end = int(np.argmax(score - low))
    start = int(np.flatnonzero(score[:end + 1] == low[end])[-1])
    return start, end, int(equal[start:end].sum())


def overlaps(docs: DataFrame, items: DataFrame, min_tokens: int = 13, id_col: str = "doc_id", item_col: str = "item_id",
             text: str = "text", item_text: str = "text", masks: Sequence[str] = MASKS) -> DataFrame:
    """Passages of ``items`` in ``docs``: ids, token ranges on both sides, and how many tokens agree.

    A passage counts with ``min_tokens`` agreeing tokens, or all of an item that has fewer, if it has no more than one
    different token for two equal ones (:func:`best_stretch`).
    """
    spark = docs.sparkSession
    bench = stage(benchmark_seeds(items, item_col, item_text, masks), "benchmark")
    lengths = bench.select(F.size("item_tokens").alias("n")).where(F.col("n").between(1, max(map(len, masks)) - 1)).distinct()
    whole = sorted(r["n"] for r in lengths.collect())  # at most one less than the span of a mask
    windows = bench.select(F.col(item_col).alias("_item"), F.explode(F.arrays_zip("h", "at")).alias("w")).select(
        "_item", F.col("w.h").alias("h"), F.col("w.at").alias("_item_at"))
    packed = spark.sparkContext.broadcast(bloom(windows))
    near = stage(neighbourhoods(docs, packed, id_col, text, masks, whole), "neighbourhoods")
    hits = near.select(F.col(id_col).alias("_doc"), "low", F.explode(F.arrays_zip("h", "at")).alias("w")).select(
        "_doc", "low", F.col("w.h").alias("h"), F.col("w.at").alias("_at"))
    shifts = hits.join(windows, "h").select("_doc", "low", "_item", (F.col("_at") - F.col("_item_at")).alias("shift")).distinct()
    pairs = shifts.join(bench.select(F.col(item_col).alias("_item"), "item_tokens"), "_item").join(
        near.select(F.col(id_col).alias("_doc2"), F.col("low").alias("_low2"), "tokens"),
        F.col("_doc").eqNullSafe(F.col("_doc2")) & (F.col("low") == F.col("_low2")))
    kinds = [docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            rows, found = [], []
            for i, (low, shift, item, part) in enumerate(zip(*[batch.column(k) for k in range(2, 6)])):
                low, shift, item, part = low.as_py(), shift.as_py(), item.values.to_numpy(), part.values.to_numpy()
                a, b = max(low, shift), min(low + len(part), shift + len(item))
                start, end, equal = best_stretch(part[a - low:b - low] == item[a - shift:b - shift])
                if equal >= min(min_tokens, len(item)):
                    rows.append(i)
                    found.append((a + start, a + end, a + start - shift, a + end - shift, equal))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), batch.column(1).take(pa.array(rows, pa.int64())),
                 *[pa.array([f[k] for f in found], pa.int64()) for k in range(5)]],
                [id_col, item_col, "doc_start", "doc_end", "item_start", "item_end", "n_equal"])

    return pairs.select("_doc", "_item", "low", "shift", "item_tokens", "tokens").mapInArrow(
        run, f"`{id_col}` {kinds[0]}, `{item_col}` {kinds[1]}, doc_start long, doc_end long, item_start long, item_end long, n_equal long").distinct()


def without_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows in whose text no passage of ``items`` was found, with all their columns; rows that share an id go each by its text."""
    rows = stage(docs.withColumn("_leak_row", F.monotonically_increasing_id()), "rows")
    leaked = stage(overlaps(rows, items, **{**options, "id_col": "_leak_row"}).select("_leak_row").distinct(), "leaked")
    return rows.join(leaked, "_leak_row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op2_spaced_seed_decontamination")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark passage in every document."""
    return overlaps(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
