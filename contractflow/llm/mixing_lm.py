"""Language-model scores by online logistic context mixing.

A token is coded as its bytes and an end mark, a byte as the yes-or-no steps of the Huffman code
that belongs to the byte before it. For each step, five predictors look up what was
seen in training under a hash of their context: the last one, two, three or five bytes of the word, or all of it so far. Their
predictions are mixed in the logistic domain by weights that a gate chooses (how often the word so far was seen), and then
refined by a bias for each level of confidence. The weights of each gate, and the biases, go on learning inside each document,
block by block, and a block is predicted before it is learned from. Blocks grow with the place in the document and with nothing else.

What is gathered from all training documents, by Spark:

1. exact counts of all tokens (counted in tasks, added in a shuffle by token);
2. counts of the steps, and from every distinct token times its count the hashed tables, added up block by block;
3. the weights, by Newton steps over the tokens of one fold of the training documents, with the fold's counts taken from the tables.

A token that training never had is one event, as in the plain counts: a mark at its start. Its rate is that of the fold's tokens
which the rest of the training documents lack. ``score`` is the log probability of the text with such tokens as that event;
``bits_per_byte`` pays for their spelling too. Which tokens training had is read from a Bloom filter of fixed size; where it
errs, a new token is paid as if it were spelled, so the score never gains by it.

A slot of a table belongs to one context: a check byte tells it from others with the same slot. All training tokens claim slots, and the
most frequent token gets one. So rare tokens fill what others leave, and cannot blur what is known of frequent ones, however many there are.

Only the tables (five of ``2**TABLE_BITS`` entries), and the counts of at most ``HEAD`` frequent tokens go to all tasks; their size does not grow.
Counts of rarer tokens are joined by a shuffle of just their occurrences. Documents are never shuffled.

Cases: a null text is empty and consists of the end token; repeated rows are scored alike; without training documents tables are
empty and every step has probability one half; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .base import pieces, query, read
from .decontaminate import bloom, passes
from .tokens import mix

TABLE_BITS = 22
ORDERS = (1, 2, 3, 5)
K, GATES = len(ORDERS) + 1, 8
HEAD = 1 << 18
BLANK, END = 32, 10
END_TOKEN, NEW_TOKEN = bytes([END]), b"\t"
_BLOCK = 1 << 13
_WORDS = 1500
_ROW = 8
_PART = 1 << 14
_SCALE = 10.0
#: Steps of learning inside a document.
RATE, BIAS_RATE, LEVELS = 0.0015, 0.004, 16


def tokens_of(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens of an Arrow column of texts, the numbers of all tokens, and where those of each text begin.

    Words are those of ``base.words``, in the order of their first occurrence; the end, last of all, closes every text.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column.cast(pa.string()).fill_null("")))  # at blank and \x09 to \x0D
    flat = lists.flatten()
    coded = flat.dictionary_encode()
    ids, first = coded.indices.to_numpy(), lists.offsets.to_numpy()
    some = pc.binary_length(flat).to_numpy() > 0  # blanks at either end split off empty words
    first = np.append(0, np.cumsum(some))[first - first[0]]
    found, ids = coded.dictionary.cast(pa.binary()), ids[some]
    used = np.zeros(len(found), bool)
    used[ids] = True
    ids = (np.cumsum(used) - 1)[ids]
    found = pa.concat_arrays([found.filter(pa.array(used)), pa.array([END_TOKEN], pa.binary())])
    return found, np.insert(ids, first[1:], len(found) - 1), first + np.arange(len(first))


def plain(column: pa.Array) -> list[bytes]:
    """Binary values, without an Arrow scalar for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def token_counts(docs: DataFrame, text: str, fold: Column) -> DataFrame:
    """``word``, its count ``c``, and its count where ``fold`` holds, over all rows; the end of a text is a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, room = [], 0

        def added() -> pa.Table:
            return pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum"), ("c_fold", "sum")]).select(
                ["word", "c_sum", "c_fold_sum"]).rename_columns(["word", "c", "c_fold"]).combine_chunks()

        for batch in pieces(batches, 500):
            found, ids, first = tokens_of(batch.column(0))
            own = ids[np.repeat(batch.column(1).fill_null(False).to_numpy(zero_copy_only=False), np.diff(first))]
            part = [np.bincount(x, minlength=len(found)) for x in (ids, own)]
            held.append(pa.table([found, *map(pa.array, part)], ["word", "c", "c_fold"]))
            room += len(found)
            if room > 600_000:
                held = [added()]
                room = len(held[0])
                if room > 400_000:
                    yield from held[0].to_batches()
                    held, room = [], 0
        if held:
            yield from added().to_batches()
        held.clear()
        pa.default_memory_pool().release_unused()  # the worker lives on

    return docs.select(F.col(text), fold).mapInArrow(run, "word binary, c long, c_fold long").groupBy("word").agg(
        F.sum("c").alias("c"), F.sum("c_fold").alias("c_fold"))


@dataclass
class Code:
    """Huffman codes of a byte after each byte, by 256 times the byte before plus the byte: length, and where nodes (hashed) and steps begin."""

    length: np.ndarray
    first: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> Code:
        """``counts``: how often a byte follows another, 256 by 256; a blank comes before the first byte of a token."""
        paths = [p for row in np.asarray(counts).reshape(256, 256) for p in _paths(row)]
        length = np.array([len(p) for p in paths], np.int32)
        node, bit = np.array([step for p in paths for step in p], np.uint32).T
        return cls(length, np.cumsum(length, dtype=np.int32) - length, node * np.uint32(0x9E3779B1), bit.astype(np.uint8))


def _paths(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """Nodes and steps from the root to each of 256 bytes."""
    heap = [(int(c) + 1, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    up, new = {}, 256
    while len(heap) > 1:
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        up[x], up[y] = (new, 0), (new, 1)
        heapq.heappush(heap, (a + b, new))
        new += 1
    below = {new - 1: []}
    for i in [*range(new - 2, -1, -1)]:
        n, b = up[i]
        below[i] = [*below[n], (n, b)]
    return [below[i] for i in range(256)]


def steps(found: list[bytes], code: Code) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For some words at a time: the number of steps of each word, slots and check bytes of all steps (K by steps), and the steps."""
    for lo in range(0, len(found), _WORDS):
        part = found[lo:lo + _WORDS]
        data = np.frombuffer(b" ".join(part) + b" ", np.uint8)
        size = np.array([len(w) for w in part]) + 1
        first = np.cumsum(size) - size
        word = np.repeat(np.arange(len(part)), size)
        at = np.arange(len(data)) - first[word]
        value = data.astype(np.uint64)
        back, last, contexts = np.zeros(len(data), np.uint64), np.uint64(BLANK), []
        for n in range(1, max(ORDERS) + 1):
            shifted = np.concatenate([np.full(min(n, len(value)), last), value[:-n]])[:len(value)]
            back |= np.where(at >= n, shifted, last) << np.uint64(8 * n)
            if n in ORDERS:
                contexts.append(mix(back + np.uint64(n)))
        prefix = np.zeros(len(data) + 1, np.uint64)
        power = np.multiply.accumulate(np.full(int(at.max()) + 2, 0x9E3779B97F4A7C15, np.uint64))
        np.cumsum((value + np.uint64(1)) * power[at], out=prefix[1:])
        contexts.append(mix(prefix[:-1] - prefix[first][word] + (at.astype(np.uint64) << np.uint64(3)) + np.uint64(7)))
        before = data[np.maximum(np.arange(len(data)) - 1, 0)]
        keep = ~((data == BLANK) & (at == 1) & ((before == END) | (before == NEW_TOKEN[0])))
        pair = np.where(at == 0, BLANK, before).astype(np.int32) * 256 + data
        length = code.length.take(pair) * keep
        ends = np.cumsum(length, dtype=np.int32)
        path = np.repeat(code.first.take(pair) - (ends - length), length)
        path += np.arange(len(path), dtype=np.int32)
        node = code.node.take(path)
        slots, check = np.empty((K, len(path)), np.intp), np.empty((K, len(path)), np.uint8)
        for k, c in enumerate(contexts):
            h = np.repeat((c >> np.uint64(32)).astype(np.uint32), length)
            h += node
            h *= np.uint32(0x85EBCA6B)
            slots[k] = h >> np.uint32(32 - TABLE_BITS)
            check[k] = h >> np.uint32(31 - TABLE_BITS - 7) & np.uint32(255)
        check |= np.uint8(1)
        yield np.add.reduceat(length, first).astype(np.int64), slots, check, code.bit.take(path)


def token_hashes(found: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in found], np.uint64)


def hashed(counts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(token_hashes(plain(batch.column(0))).view(np.int64))], ["h"])

    return counts.select("word").mapInArrow(run, "h long")


def byte_counts(counts: DataFrame) -> np.ndarray:
    """How often each byte follows each other one in the tokens, 256 by 256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16)
        for batch in batches:
            found, c = plain(batch.column(0)), batch.column(1).to_numpy().astype(float)
            data = np.frombuffer(b" ".join([b"", *found, b""]), np.uint8).astype(np.int64)
            weight = np.repeat(c, [len(w) + 1 for w in found])
            total += np.bincount(data[:-1] * 256 + data[1:], weight, 1 << 16)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["b", "n"])

    out = np.zeros(1 << 16)
    for r in counts.select("word", "c").mapInArrow(run, "b int, n double").groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[r["b"]] = r["n"]
    return out.reshape(256, 256)


def owners(counts: DataFrame, code: Code, words_a_task: int = 4_000_000) -> np.ndarray:
    """Check bytes of the contexts that own the slots, of all tokens: in each slot that of the most frequent token. 0: nobody's.

    A task claims slots for its words in a table of fixed size; blocks of these are compared by number.
    """
    size = 1 << TABLE_BITS
    parts = max(1, -(-counts.count() // words_a_task))

    def claim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((K, size), np.uint32)
        for batch in batches:
            found, c = plain(batch.column(0)), np.minimum(batch.column(1).to_numpy(), (1 << 24) - 2).astype(np.uint32)
            c[[w == NEW_TOKEN for w in found]] = (1 << 24) - 1
            done = 0
            for n, slots, check, _ in steps(found, code):
                claims = np.repeat(c[done:done + len(n)] << np.uint32(8), n)
                done += len(n)
                for k in range(K):
                    np.maximum.at(table[k], slots[k], claims | check[k])
        for k in range(K):
            for i in range(0, size, _BLOCK):
                if table[k, i:i + _BLOCK].any():
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([i // _BLOCK], pa.int32()), pa.array(
                        [zlib.compress(table[k, i:i + _BLOCK].tobytes(), 1)], pa.binary())], ["k", "block", "data"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, most = None, None

        def done():
            checks = zlib.compress((most & np.uint32(255)).astype(np.uint8).tobytes(), 1)
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([checks], pa.binary())],
                                              ["k", "block", "data"])

        for batch in batches:
            for k, b, data in zip(*[batch.column(i) for i in range(3)]):
                if (k.as_py(), b.as_py()) != key:
                    if key:
                        yield done()
                    key, most = (k.as_py(), b.as_py()), np.zeros(_BLOCK, np.uint32)
                most = np.maximum(most, np.frombuffer(zlib.decompress(data.as_py()), np.uint32))
        if key:
            yield done()

    schema, out = "k int, block int, data binary", np.zeros((K, size), np.uint8)
    claims = counts.select("word", "c").coalesce(parts).mapInArrow(claim, schema)
    for r in claims.repartition("k", "block").sortWithinPartitions("k", "block").mapInArrow(settle, schema).toLocalIterator():  # fixed size
        out[r["k"], r["block"] * _BLOCK:(r["block"] + 1) * _BLOCK] = np.frombuffer(zlib.decompress(r["data"]), np.uint8)
    return out


@dataclass
class Tables:
    """What the predictors say (``K`` by slots, in tenths of a logistic unit), and gates of the last one's slots."""

    code: Code
    stretch: np.ndarray
    gate: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, K), 0.3))


def _said(counts: np.ndarray) -> tuple[bytes, bytes]:
    """What a predictor says, and the gate, from the counts of both steps in turn."""
    n0, n1 = np.maximum(counts[0::2], 0), np.maximum(counts[1::2], 0)
    n = n0 + n1
    stretch = np.clip(np.rint(np.log((n1 + 0.3) / (n0 + 0.3)) * _SCALE), -127, 127).astype(np.int8)
    gate = np.where(n == 0, 0, np.where(np.minimum(n0, n1) == 0, 2 + (n >= 3) + (n >= 12), 5 + (n >= 16) + (n >= 256))).astype(np.uint8)
    return stretch.tobytes(), gate.tobytes()


def fill_tables(counts: DataFrame, code: Code, owner, words_a_task: int = 4_000_000) -> tuple[Tables, Tables]:
    """Tables of all tokens, and of all but the fold's.

    A task adds up its words in a table of fixed size. Blocks of these are added up by number; the driver gets one byte a slot.
    """
    size = 1 << TABLE_BITS
    parts = max(1, -(-counts.count() // words_a_task))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, fold = np.zeros((K, 2 * size), np.float32), None
        for batch in batches:
            found, c = plain(batch.column(0)), batch.column(1).to_numpy().astype(np.float32)
            fold = batch.column(2)[0].as_py() if batch.num_rows else fold
            done = 0
            for n, slots, check, bit in steps(found, code):
                weight = np.repeat(c[done:done + len(n)], n)
                done += len(n)
                for k in range(K):
                    own = np.flatnonzero(owner.value[k][slots[k]] == check[k])
                    np.add.at(table[k], 2 * slots[k][own].astype(np.int64) + bit[own], weight[own])
        for k in range(K if fold is not None else 0):
            for b in range(0, 2 * size, 8 * _BLOCK):
                rows = [(k, i // _BLOCK, fold, zlib.compress(table[k, i:i + _BLOCK].tobytes(), 1))
                        for i in range(b, min(2 * size, b + 8 * _BLOCK), _BLOCK) if table[k, i:i + _BLOCK].any()]
                kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["k", "block", "fold", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None

        def done():
            made = [zlib.compress(x, 1) for x in (*_said(total[0]), *_said(total[0] - total[1]))]
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), *[pa.array([x], pa.binary()) for x in made]],
                                              ["k", "block", "s0", "g0", "s1", "g1"])

        for batch in batches:
            for k, b, fold, data in zip(*[batch.column(i) for i in range(4)]):
                if (k.as_py(), b.as_py()) != key:
                    if key:
                        yield done()
                    key, total = (k.as_py(), b.as_py()), np.zeros((2, _BLOCK))
                total[int(fold.as_py())] += np.frombuffer(zlib.decompress(data.as_py()), np.float32)
        if key:
            yield done()

    def blocks(column: str, fold: bool) -> DataFrame:
        rows = counts.where(F.col(column) > 0).select("word", column, F.lit(fold).alias("fold"))
        return rows.coalesce(parts).mapInArrow(count, "k int, block int, fold boolean, data binary")

    made = blocks("c", False).union(blocks("c_fold", True)).repartition("k", "block").sortWithinPartitions("k", "block").mapInArrow(
        add, "k int, block int, s0 binary, g0 binary, s1 binary, g1 binary")
    out, half = [Tables(code, np.zeros((K, size), np.int8), np.zeros(size, np.uint8)) for _ in range(2)], _BLOCK // 2
    for r in made.toLocalIterator():  # tables of fixed size
        at = slice(r["block"] * half, (r["block"] + 1) * half)
        for i, t in enumerate(out):
            t.stretch[r["k"], at] = np.frombuffer(zlib.decompress(r[f"s{i}"]), np.int8)
            if r["k"] == K - 1:
                t.gate[at] = np.frombuffer(zlib.decompress(r[f"g{i}"]), np.uint8)
    return out[0], out[1]


def inputs(found: list[bytes], t: Tables, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all words: where the steps of each begin, and a row a step: ``K`` predictions as they are in ``t``, the gate, 1 or -1 for the step.

    The gate tells how often the word so far was seen, and whether the same step always followed; if it was never seen,
    whether the last five bytes were.
    """
    n, rows = [np.zeros(1, np.int64)], [np.zeros((0, _ROW), np.int8)]
    for size, slots, check, bit in steps(found, t.code):
        part = np.zeros((len(bit), _ROW), np.int8)
        for k in range(K):
            own = owner[k].take(slots[k]) == check[k]
            np.multiply(t.stretch[k].take(slots[k]), own, out=part[:, k])
            if k == K - 2:
                part[:, K] = own
            if k == K - 1:
                np.maximum(part[:, K], t.gate.take(slots[k]).view(np.int8) * own, out=part[:, K])
        part[:, K + 1] = bit.view(np.int8) * np.int8(2) - np.int8(1)
        n.append(size), rows.append(part)
    return np.cumsum(np.concatenate(n)), np.concatenate(rows)


class Features:
    """:func:`inputs` of words, the steps of earlier words of this worker kept, up to ``room`` of them."""

    def __init__(self, tables: Tables, owner: np.ndarray, room: int = 3 << 20):
        self.tables, self.owner, self.words, self.start = tables, owner, {}, [0]
        self.kept = np.empty((room, _ROW), np.int8)

    def of(self, found: list[bytes], keep: np.ndarray | None = None) -> tuple[list[int], np.ndarray, np.ndarray]:
        """An order of ``found``, and the inputs of its words in that order and of the mark of new words after them.

        ``keep`` tells the words that are likely to come again; without it all are kept.
        """
        place = [self.words.get(w, -1) for w in found]
        old, fresh = [i for i, p in enumerate(place) if p >= 0], [i for i, p in enumerate(place) if p < 0]
        if keep is not None:
            fresh.sort(key=(~keep).tolist().__getitem__)
        first, made = inputs([*[found[i] for i in fresh], NEW_TOKEN], self.tables, self.owner)
        start, used = np.array(self.start), self.start[-1]
        at = np.array([place[i] for i in old], np.int64)
        size = start[at + 1] - start[at]
        ends = np.cumsum(size)
        total = int(size.sum())
        rows = np.repeat(start[at] - (ends - size), size)
        rows += np.arange(total)
        out = np.concatenate([self.kept.take(rows, axis=0), made])
        n = min(len(fresh) if keep is None else int(keep[fresh].sum()), int(np.searchsorted(first, len(self.kept) - used, side="right")) - 1)
        self.kept[used:used + first[n]] = made[:first[n]]
        self.words.update((found[i], len(self.start) - 1 + j) for j, i in enumerate(fresh[:n]))
        self.start.extend((used + first[1:n + 1]).tolist())
        return [*old, *fresh], np.concatenate([np.zeros(1, np.int64), ends, total + first[1:]]), out


def first_weights(counts: DataFrame, tables, owner, rounds: int = 4) -> np.ndarray:
    """Weights of each gate that fit the fold's tokens best, by Newton's method; tasks send sums of fixed size."""
    w = np.full((GATES, K), 0.3)
    rows = counts.where("c_fold > 0").select(F.when(F.col("c") == F.col("c_fold"), F.lit(NEW_TOKEN)).otherwise(F.col("word")).alias("word"), "c_fold")
    for _ in range(rounds):
        def run(batches: Iterator[pa.RecordBatch], w=w) -> Iterator[pa.RecordBatch]:
            total, t = np.zeros((GATES, K + 1, K)), tables.value
            for batch in batches:
                found, c = plain(batch.column(0)), batch.column(1).to_numpy().astype(np.float64)
                for lo in range(0, len(found), 10_000):
                    own = Counter()
                    for token, n in zip(found[lo:lo + 10_000], c[lo:lo + 10_000]):
                        own[token] += n
                    first, made = inputs(list(own), t, owner.value)
                    order = np.argsort(made[:, K], kind="stable")
                    made, weight = made.take(order, axis=0), np.repeat(np.array(list(own.values())), np.diff(first)).take(order)
                    x = (made[:, :K] * np.float32(1 / _SCALE)).astype(np.float64)
                    ends = np.searchsorted(made[:, K], np.arange(GATES + 1))
                    for g in range(GATES):
                        m = slice(ends[g], ends[g + 1])
                        xg, wg = x[m], weight[m]
                        pg = 1 / (1 + np.exp(-np.clip(xg @ w[g], -20, 20)))
                        total[g, 0] += xg.T @ (wg * ((made[m, K + 1] > 0) - pg))
                        total[g, 1:] += (xg * (wg * pg * (1 - pg))[:, None]).T @ xg
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["s"])

        sums = rows.mapInArrow(run, "s array<double>").select(F.posexplode("s")).groupBy("pos").agg(F.sum("col").alias("v")).collect()
        if not sums:
            return w
        total = np.zeros(GATES * (K + 1) * K)
        for r in sums:
            total[r["pos"]] = r["v"]
        total = total.reshape(GATES, K + 1, K)
        w = w + np.stack([np.clip(np.linalg.solve(total[g, 1:] + np.eye(K), total[g, 0] - (w[g] - 0.3)), -1, 1) for g in range(GATES)])
    return w


def block_sizes(n: int) -> Iterator[tuple[int, int]]:
    """Blocks of ``n`` steps: 64 at first, twice as many after every 16 blocks, 2048 at most."""
    at, size, nr = 0, 64, 0
    while at < n:
        yield at, size
        at, nr = at + size, nr + 1
        if nr % 16 == 0 and size < 2048:
            size *= 2


def mixed(first: np.ndarray, x: np.ndarray, gate: np.ndarray, bit: np.ndarray, texts: list[np.ndarray], new: np.ndarray,
          start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """:func:`mixed_rows` of predictions, gates and steps apart."""
    rows = np.zeros((len(x), _ROW), x.dtype)
    rows[:, :K], rows[:, K], rows[:, K + 1] = x, gate, 2 * bit.astype(np.int8) - 1
    return mixed_rows(first, rows, texts, new, start)


def places(first: np.ndarray, texts: list[np.ndarray], total: np.ndarray, room: np.ndarray, none: int) -> list[np.ndarray]:
    """The row of each step of each text; ``none`` from its end up to its ``room``."""
    begin, size, out = first[:-1].astype(np.int32), np.diff(first).astype(np.int32), []
    for t, n, r in zip(texts, total, room):
        s = size[t]
        rows = np.full(r, none, np.int32)
        np.add(np.repeat(begin[t] - (np.cumsum(s, dtype=np.int32) - s), s), np.arange(n, dtype=np.int32), out=rows[:n])
        out.append(rows)
    return out


def mixed_rows(first: np.ndarray, rows: np.ndarray, texts: list[np.ndarray], new: np.ndarray, start: np.ndarray,
               unit: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Natural log probability of each text, a list of word numbers, and that of spelling its new words.

    The last word of ``first`` is the mark that a new word starts with. All texts move on together, the longest first; in a block each
    takes as many rows (see :func:`inputs`, predictions in ``unit``), empty ones after its end, and some texts at a time go through it.
    """
    size, mark = np.diff(first), len(first) - 2
    coded = []
    for t in texts:
        at = np.flatnonzero(new[t])
        coded.append(np.insert(t, at, mark) if len(at) else t)
    total = np.array([int(size[t].sum()) for t in coded], np.int64)
    order = np.argsort(-total, kind="stable")
    total = total[order]
    blocks = [*block_sizes(int(total[0]) if len(total) else 0)]
    ends = np.array([0, *[at + n for at, n in blocks]])
    rows = np.concatenate([rows, np.zeros((1, _ROW), rows.dtype)])
    if mark >= 0:
        rows[:-1, K + 2] = np.repeat(np.append(new, False), size)  # whether it spells a new word
    where = places(first, [coded[i] for i in order], total, ends[np.searchsorted(ends, total)], len(rows) - 1)
    any_new = bool(new.any())
    w = np.repeat((start.T * unit).astype(np.float32)[None], len(texts), axis=0)
    bias = np.zeros((len(texts), LEVELS), np.float32)
    out, spelled = np.zeros(len(texts)), np.zeros(len(texts))
    low, high, one = np.float32(-16), np.float32(16), np.float32(1)
    for at, n in blocks:
        rate, bias_rate = np.float32(RATE * min(1.0, 256 / n) * unit ** 2), np.float32(BIAS_RATE * min(1.0, 64 / n))
        a, some = int(np.searchsorted(-total, -at, side="left")), max(1, _PART // n)  # texts that go on, texts at a time
        for lo in range(0, a, some):
            hi = min(a, lo + some)
            m = hi - lo
            row = rows.take(np.concatenate([p[at:at + n] for p in where[lo:hi]]), axis=0).astype(np.float32, copy=False)
            x, to = row.reshape(m, n, _ROW)[:, :, :K], row[:, K + 1].copy()
            cell = row[:, K].astype(np.intp)
            cell += np.arange(0, m * n * GATES, GATES)
            z = np.matmul(x, w[lo:hi]).reshape(-1).take(cell)
            level = np.clip(z + np.float32(LEVELS // 2), np.float32(0), np.float32(LEVELS - 1)).astype(np.intp)
            level += np.repeat(np.arange(0, m * LEVELS, LEVELS), n)
            z += bias[lo:hi].reshape(-1).take(level)
            z *= to
            e = np.exp(-np.clip(z, low, high, out=z))
            u = one + e
            error = e / u * to
            loss = (np.log(u) + (e - (u - one)) / u).reshape(m, n)  # log1p(e)
            for i in range(hi - 1, lo - 1, -1):
                if total[i] >= at + n:
                    break
                loss[i - lo, total[i] - at:] = 0
            out[lo:hi] -= loss.sum(axis=1)
            if any_new:
                loss *= row[:, K + 2].reshape(m, n)
                spelled[lo:hi] -= loss.sum(axis=1)
            by_gate = np.zeros(m * n * GATES, np.float32)
            by_gate[cell] = error
            w[lo:hi] += rate * np.matmul(x.transpose(0, 2, 1), by_gate.reshape(m, n, GATES))
            bias[lo:hi] += bias_rate * np.bincount(level, error, m * LEVELS).reshape(m, LEVELS).astype(np.float32)
    back = np.empty((2, len(texts)))
    back[:, order] = out - spelled, spelled
    return back[0], back[1]


@dataclass
class Model:
    """All that scoring needs; ``counts`` has the exact count of every training token."""

    counts: DataFrame
    tokens: int
    distinct: int
    tables: object
    owner: object
    head: object
    known: object


def learn(docs: DataFrame, fold: Column, text: str = "text", head: int = HEAD) -> Model:
    """Learn from all rows of ``docs``. ``fold`` is true for the rows that set the first weights."""
    sc = docs.sparkSession.sparkContext
    counts = stage(token_counts(docs, text, fold), "counts")
    row = counts.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), F.coalesce(F.sum("c_fold"), F.lit(0)).alias("fold"),
        F.coalesce(F.sum(F.when(F.col("c") == F.col("c_fold"), F.col("c_fold"))), F.lit(0)).alias("new")).first()
    new = max(1, round(row["n"] * row["new"] / max(1, row["fold"])))
    extra = counts.sparkSession.createDataFrame([(bytearray(NEW_TOKEN), new, 0)], "word binary, c long, c_fold long")
    level = F.floor(F.log2("c") * 16).cast("int")
    room, least = head, None
    for r in sorted(counts.groupBy(level.alias("at")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["at"]):
        room -= r["n"]
        if room < 0:
            break
        least = r["at"]
    frequent: dict[bytes, int] = {}
    if least is not None:  # at most ``head`` rows
        found = counts.where(level >= least).select("word", "c").toArrow()
        frequent = dict(sorted(zip(plain(found.column(0)), found.column(1).to_pylist()), key=lambda r: (r[1], r[0])))
        del found
    more = counts.union(extra)
    code = Code.of(byte_counts(more))
    owner = sc.broadcast(owners(more, code))
    tables, rest = fill_tables(more, code, owner)
    without = sc.broadcast(rest)
    weights = first_weights(counts, without, owner)
    without.destroy()
    tables.weights = weights
    return Model(counts, row["n"], row["v"], sc.broadcast(tables), owner, sc.broadcast(frequent),
                 sc.broadcast(bloom(hashed(counts))))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row a document: tokens, known tokens, log10 probability by counts alone and by mixing, and bits for each byte."""
    kind = docs.schema[id_col].dataType.simpleString()
    tables, owner, head, known = model.tables, model.owner, model.head, model.known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, t, frequent = TaskContext.get().partitionId() << 40, tables.value, head.value
        bits = np.frombuffer(known.value, np.uint8)
        held = t.__dict__.setdefault("features", Features(t, owner.value))  # of this worker, for all its tasks
        for batch in pieces(batches, 250):
            every, ids, first = tokens_of(batch.column(1))
            found, n_bytes = plain(every), pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
            c = np.array([frequent.get(w, 0) for w in found], np.int64)
            new = c == 0
            rarer = np.flatnonzero(new)
            new[rarer[passes(token_hashes([found[i] for i in rarer]), bits)]] = False
            order, begin, x = held.of(found, c > 0)  # a new token is its mark, and then its spelling
            moved = np.empty(len(found), np.int64)
            moved[order] = np.arange(len(order))
            nats, spelled = mixed_rows(begin, x, np.split(moved[ids], first[1:-1]), new[order], t.weights, 1 / _SCALE)
            # rare tokens of each text, once each
            rare = np.flatnonzero(c[ids] == 0)
            which, times = np.unique((np.searchsorted(first, rare, side="right") - 1) * len(found) + ids[rare], return_counts=True)
            each = pa.array(np.searchsorted(which, np.arange(len(first)) * len(found)), pa.int32())
            rows = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(rows), pa.array(np.diff(first), pa.int64()), pa.array(np.add.reduceat(c[ids] > 0, first[:-1], dtype=np.int64)),
                pa.array(np.add.reduceat(np.log10(c + 1.0)[ids], first[:-1])), pa.array(nats / np.log(10)),
                pa.array((nats + spelled) / -np.log(2) / np.maximum(1, n_bytes)),
                pa.ListArray.from_arrays(each, every.take(pa.array(which % len(found)))), pa.ListArray.from_arrays(each, pa.array(times, pa.int64()))],
                [id_col, "_row", "n_tokens", "_known", "_base", "score", "bits_per_byte", "_rare", "_times"])

    rows = stage(docs.select(id_col, text).mapInArrow(
        run, f"`{id_col}` {kind}, _row long, n_tokens long, _known long, _base double, score double, bits_per_byte double, "
             "_rare array<binary>, _times array<long>"), "scores")
    rare = rows.select("_row", F.explode(F.arrays_zip("_rare", "_times")).alias("w")).select(
        "_row", F.col("w._rare").alias("word"), F.col("w._times").alias("times"))
    rare = rare.join(model.counts.select("word", "c"), "word").groupBy("_row").agg(
        F.sum("times").alias("_more"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("_add"))
    whole = F.log10(F.lit(float(model.tokens) + float(model.distinct) + 1.0))
    return rows.join(rare, "_row", "left").select(
        id_col, "n_tokens", (F.col("_known") + F.coalesce("_more", F.lit(0))).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_add", F.lit(0.0)) - F.col("n_tokens") * whole).alias("base_score"), "score", "bits_per_byte")


@query("op3_context_mixing_lm")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out seventh."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    fold = crc % 7
    found = score(docs, learn(docs.where(fold != 2), fold == 3))
    return found.select("doc_id", (fold == 2).alias("held_out"), *[c for c in found.columns if c != "doc_id"])
