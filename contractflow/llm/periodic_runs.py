"""Periodic runs of words, found by internal pattern matching, and texts with the repetitions taken out.

A run is a stretch of words with smallest period ``q`` and length of at least ``max(min_words, min_periods * q)`` that no neighbouring
word extends keeping period ``q``. Texts of an Arrow batch are laid one after the other, each word a number that no other text has, so
all steps are array operations over many texts and no match leaves its text.

Method. Ranks of the substrings of ``2**k`` words come from doubling, which also refines a suffix array; only places whose substring
occurs again are ranked further. A run of period ``q`` with ``2**k <= q < 2**(k+1)`` holds an aligned block of ``2**k`` words that
occurs again ``q`` words on, so each such block asks for its occurrences in the next window of as many places (and blocks of the lowest
level in the window before it, for shorter periods). Occurrences are values in the block's interval of the suffix array; a wavelet tree
over it answers range successor queries. Those in one window form an arithmetic progression: one or two give their distances; three or
more have the block's own period as difference, and then the distance of the starts, or of the ends, of the two maximal stretches of
that period is the period of the run. Candidates are extended by comparing ranks level by level; of equal stretches the smallest period stays.

Cases: null, empty and short texts have no runs; texts of any length are taken whole (memory: ranks of four bytes a word and level,
batches of at most ``BATCH_WORDS`` words unless one text is longer); repeated rows and null ids are treated each by itself; an empty
table gives no rows. Columns beside id and text are not read and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import pieces, query, read, utf8

BATCH_WORDS = 1 << 18
#: Blocks of the lowest level: 2**3 words.
LOWEST = 3


@dataclass
class Blocks:
    """Aligned blocks of ``2**level`` words that occur more than once, with their intervals of the suffix array."""

    level: int
    at: np.ndarray
    low: np.ndarray
    high: np.ndarray


def doubled_ranks(codes: np.ndarray, longest: int) -> tuple[list[np.ndarray], np.ndarray, list[Blocks]]:
    """Ranks by level, the suffix array as far as it is refined, and the blocks of each level up to periods of ``longest``."""
    n = len(codes)
    suffixes = np.argsort(codes, kind="stable")
    ordered = codes[suffixes]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, n))
    ranks = np.empty(n, np.int32)
    ranks[suffixes] = np.repeat(heads, sizes)
    active = suffixes[np.repeat(sizes, sizes) > 1]
    levels, blocks, level = [ranks], [], 0
    while len(active) and 1 << (level + 1) <= max(longest, 1 << LOWEST):
        after = active + (1 << level)
        first = ranks[active].astype(np.int64)
        second = np.where(after < n, ranks[np.minimum(after, n - 1)], -1)
        key = first * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        places, key, first = active[order], key[order], first[order]
        m = len(places)
        index = np.arange(m)
        outer, inner = np.ones(m, bool), np.ones(m, bool)
        outer[1:] = first[1:] != first[:-1]
        inner[1:] = key[1:] != key[:-1]
        in_class = index - np.maximum.accumulate(np.where(outer, index, 0))
        heads = np.flatnonzero(inner)
        sizes = np.diff(np.append(heads, m))
        ranks = ranks.copy()
        ranks[places] = np.repeat((first + in_class)[heads], sizes)
        suffixes[first + in_class] = places
        size = np.repeat(sizes, sizes)
        active, size = places[size > 1], size[size > 1]
        level += 1
        levels.append(ranks)
        if level >= LOWEST:
            aligned = active % (1 << level) == 0
            at = active[aligned]
            blocks.append(Blocks(level, at, ranks[at].astype(np.int64), ranks[at] + size[aligned]))
    return levels, suffixes, blocks


class WaveletTree:
    """Values by place, one bit of all values a level; each query array is answered level by level at once."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.zeros: list[np.ndarray] = []
        for bit in reversed(range(self.bits)):
            one = (values >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            values = np.concatenate([values[~one], values[one]])

    def smaller(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values at places ``low`` to ``high`` are below ``x``."""
        over, count = x >= 1 << self.bits, np.zeros(len(x), np.int64)
        every = high - low
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            a, b = zeros[low], zeros[high]
            one = (x >> bit & 1).astype(bool)
            count += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return np.where(over, every, count)

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value at rank ``k`` (from 0) of those at places ``low`` to ``high``."""
        value = np.zeros(len(k), np.int64)
        for bit, zeros in zip(reversed(range(self.bits)), self.zeros):
            a, b = zeros[low], zeros[high]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            value |= one.astype(np.int64) << bit
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return value


def common(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
    """Equal words from places ``i`` and ``j`` on, or before them."""
    n, total = len(levels[0]), np.zeros(len(i), np.int64)
    top = len(levels) - 1
    for level in reversed(range(len(levels))):
        step, ranks = 1 << level, levels[level]
        todo = np.arange(len(i))
        while len(todo):
            a, b = (i[todo] - total[todo] - step, j[todo] - total[todo] - step) if back else (i[todo] + total[todo], j[todo] + total[todo])
            inside = (a >= 0) & (b >= 0) & (a < n) & (b < n)
            todo, a, b = todo[inside], a[inside], b[inside]
            todo = todo[ranks[a] == ranks[b]]
            total[todo] += step
            if level < top:
                break
    return total


def stretch(levels: list[np.ndarray], at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretch around ``at`` in which words ``period`` apart are equal."""
    return at - common(levels, at, at + period, back=True), at + period + common(levels, at, at + period)


def candidates(levels: list[np.ndarray], tree: WaveletTree, blocks: Blocks, low: np.ndarray, high: np.ndarray,
               first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and the periods that their occurrences ``first`` to ``last - 1`` words on allow."""
    before = tree.smaller(low, high, blocks.at + first)
    found = tree.smaller(low, high, blocks.at + last) - before
    some, more, many = found > 0, found > 1, found > 2
    at = [blocks.at[some], blocks.at[more & ~many]]
    one = tree.smallest(low[some], high[some], before[some])
    two = tree.smallest(low[more], high[more], before[more] + 1)
    period = [one - blocks.at[some], two[~many[more]] - at[1]]
    if many.any():
        b, x = blocks.at[many], one[many[some]]
        step = two[many[more]] - x
        s1, e1 = stretch(levels, b, step)
        s2, e2 = stretch(levels, x, step)
        at += [b, b]
        period += [s2 - s1, e2 - e1]
    at, period = np.concatenate(at), np.concatenate(period)
    fits = (period >= first) & (period < last)
    return at[fits], period[fits]


def runs_of(codes: np.ndarray, longest_text: int, min_words: int, min_periods: int) -> np.ndarray:
    """Rows of start, end and period of all runs, by start and period; ``codes`` has a word of its own between texts."""
    levels, suffixes, blocks = doubled_ranks(codes, longest_text // min_periods)
    blocks = [b for b in blocks if len(b.at)]
    if not blocks:
        return np.zeros((0, 3), np.int64)
    # Only places that some block's interval covers enter the tree.
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, blocks[0].low, 1)
    np.add.at(cover, blocks[0].high, -1)
    for b in blocks[1:]:
        np.add.at(cover, b.low, 1)
        np.add.at(cover, b.high, -1)
    used = np.cumsum(cover[:-1]) > 0
    place = np.concatenate([[0], np.cumsum(used)])
    tree = WaveletTree(suffixes[used])
    at, period = [], []
    for b in blocks:
        low, high = place[b.low], place[b.high]
        size = 1 << b.level
        for window in ([(1, size + 1)] if b.level == LOWEST else []) + [(size, 2 * size)]:
            found = candidates(levels, tree, b, low, high, *window)
            at.append(found[0])
            period.append(found[1])
    at, period = np.concatenate(at), np.concatenate(period)
    start, end = stretch(levels, at, period)
    long = end - start >= np.maximum(min_words, min_periods * period)
    start, end, period = start[long], end[long], period[long]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    found = np.stack([start[keep], end[keep], period[keep]], 1)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def text_runs(texts: list[list[bytes]], min_words: int = 24, min_periods: int = 3) -> list[list[tuple[int, int, int]]]:
    """Start, length and period of the runs of each text."""
    codes, first, base = [], [], 0
    for found in texts:
        seen: dict[bytes, int] = {}
        first.append(len(codes))
        codes += [base + seen.setdefault(w, len(seen)) for w in found]
        base += len(seen)
        codes.append(base)
        base += 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not codes:
        return out
    runs = runs_of(np.array(codes, np.int64), max(map(len, texts)), min_words, min_periods)
    owner = np.searchsorted(first, runs[:, 0], side="right") - 1
    for text, (start, end, period) in zip(owner.tolist(), runs.tolist()):
        out[text].append((start - first[text], end - start, period))
    return out


def collapsed(found: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside the repetitions: of each run its first period stays."""
    if runs:
        keep = np.ones(len(found), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        found = [found[i] for i in np.flatnonzero(keep)]
    return b" ".join(found)


def portions(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    """Word lists in portions of about ``BATCH_WORDS`` words."""
    out, size = [], 0
    for text in texts:
        found = text.split()  # splits at blank and \x09 to \x0D
        if out and size + len(found) > BATCH_WORDS:
            yield out
            out, size = [], 0
        out.append(found)
        size += len(found)
    if out:
        yield out


def periodic_runs(docs: DataFrame, min_words: int = 24, min_periods: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row its id, ``n_words``, ``runs`` (start, length and period, by start and period) and ``collapsed``, the text without
    the repetitions. ``min_words`` is 24 at least and ``min_periods`` 3 at least; below that a run may lack the blocks that find it."""
    if min_words < 24 or min_periods < 3:
        raise ValueError("runs shorter than 24 words or three periods are not searched for")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sizes, all_runs, bodies = [], [], []
            for part in portions(utf8(batch.column(1))):
                found = text_runs(part, min_words, min_periods)
                sizes += map(len, part)
                all_runs += found
                bodies += map(collapsed, part, found)
            flat = np.array([r for runs in all_runs for r in runs], np.int64).reshape(-1, 3)
            offsets = pa.array(np.cumsum([0, *map(len, all_runs)]), pa.int32())
            entries = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, entries),
                pa.array(bodies, pa.binary()).cast(pa.string(), safe=False)], [id_col, "n_words", "runs", "collapsed"])

    return docs.select(id_col, text).mapInArrow(
        run, f"`{id_col}` {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_repetitions(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` in which one text of ten, by the checksum of its id, goes round in a period of its own from some word on.
    Texts of null ids stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def changed(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        turns = F.ceil((n - a) / p).cast("int")
        new = F.slice(F.concat(F.slice(words, 1, a), F.flatten(F.array_repeat(F.slice(words, a + 1, p), turns))), 1, n)
        return F.when(n > 0, F.array_join(new, " ")).otherwise("")

    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # A one-element array binds the words to a name, so they are split once.
    new = F.transform(F.array(words), changed)[0]
    return docs.withColumn(text, F.when((F.pmod(h, F.lit(10)) == 0) & F.col(text).isNotNull(), new).otherwise(F.col(text)))


def longest_by_exponent(runs: str = "runs") -> Column:
    """The run with the greatest length by period, compared exactly; the first of equals, in order of start and period."""
    none = F.struct(*[F.lit(None).cast("long").alias(c) for c in ("start", "length", "period")])
    return F.aggregate(runs, none, lambda best, r: F.when(
        best["period"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


@query("op11_periodic_runs")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """The runs of all documents, a tenth of them with planted repetitions, and checksums of the runs and of what is left without them."""
    found = periodic_runs(with_repetitions(read(spark, folder, "documents"))).withColumn("_best", longest_by_exponent())
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words")
