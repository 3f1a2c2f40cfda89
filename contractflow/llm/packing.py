"""Best-fit packing of token sequences: bounded-space online best-fit over a bitset of free spaces.

Texts become token ids in Arrow batches, a stored row a piece. Keys and lengths alone are dealt round robin into
partitions of about ``group_rows`` rows, longest first, and each partition is packed as its rows stream by; then the ids are joined to
their places by key, in partitions of the shuffle. The ids of a sequence are those of its pieces in order of ``offset``; checksums
are made of the packed ids. At most ``open_bins``
sequences are open; bit ``f`` of an integer says that one with ``f`` free places is open, so the best fit for a piece of
length ``n`` is the lowest set bit from ``n`` up. When a new sequence would be one too many, the fullest closes first.

Cases: a null or empty text is the end id alone; repeated rows are packed each; a piece that fills a sequence is alone in it;
an empty table gives no rows. Input columns beside id and text are not read and cannot clash.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .base import pieces as small
from .base import query, read, utf8

#: Token ids of words seen by this worker are kept up to so many words, then forgotten; results do not depend on it.
CACHE_WORDS = 600_000
PIECES = "_key long, piece int, start long, length long, ids array<int>"


#: Documents that become ids at once in a task.
STEP = 200


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: ASCII marks; a run of them after letters, or alone, is one piece for the tokenizer.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


class WordTokens(dict):
    """Token ids by a tokenizer whose tokens never span ASCII white space, as little-endian 32-bit words in bytes.

    A map from white-space separated runs to their ids: each run is encoded when it is first asked for, and remembered. Runs of Latin
    letters that may end in marks, nearly all of a text, are put in lower case here and their parts go to the tokenizer's
    model; any other run goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.parts = self.tokenizer.model, {}
        setup = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in setup["normalizer"]["normalizers"]] if setup["normalizer"] else []
        #: What :meth:`plain` does by itself; for any other set-up all runs take the long way.
        self.simple = steps == ["NFC", "Replace", "Lowercase"] and setup["model"]["end_of_word_suffix"] == "</w>"
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.letters = {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}

    def part(self, text: str) -> bytes:
        """Ids of letters, or of marks, in lower case."""
        found = self.parts.get(text)
        if found is None:
            as_bytes = text if text.isascii() else "".join(map(self.letters.__getitem__, text.encode()))
            found = self.parts[text] = array("I", [t.id for t in self.model.tokenize(as_bytes)]).tobytes()
        return found

    def plain(self, run: bytes) -> bytes | None:
        """Ids of a run, or nothing if it isn't Latin letters with marks after them at most."""
        if run.isascii():
            text = run.decode().lower()
        else:
            text = run.decode("utf-8", "replace")
            # No character up to U+024F is changed by normalisation, or by its neighbours when it is put in lower case.
            if max(text) > "\u024f" or "\u0130" in text:
                return None
            text = text.lower()
        if text.isalpha():
            return self.part(text)
        head = text.rstrip(MARKS)
        if not head:
            return self.part(text)
        if len(head) < len(text) and head.isalpha():
            return self.part(head) + self.part(text[len(head):])
        return None

    def __missing__(self, run: bytes) -> bytes:
        found = self.plain(run) if self.simple else None
        if found is None:
            found = array("I", self.tokenizer.encode(run.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()
        self[run] = found
        return found

    def __call__(self, texts: list[bytes]) -> Iterator[bytes]:
        for text in texts:
            if len(self) > CACHE_WORDS:
                self.clear()
                self.parts.clear()
            yield b"".join(map(self.__getitem__, text.split()))


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One for each path and Python worker, which serves many tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]


def token_pieces(docs: DataFrame, limit: int, id_col: str = "doc_id", text: str = "text",
                 path: str | None = None, end_id: int = 0) -> DataFrame:
    """One row for each piece of at most ``limit`` tokens of a document: a key, its place there, and its ids. To be stored, as keys
    are numbers of rows of a task."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = word_tokens(path or tokenizer_path()), array("I", [end_id]).tobytes()
        key = TaskContext.get().partitionId() << 40
        for batch in small(batches, STEP):
            row, piece, start, length, parts = [], [], [], [], []
            for i, ids in enumerate(tokens(utf8(batch.column(1)))):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at:at + 4 * limit]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    parts.append(part)
            at = pa.array(np.cumsum([0, *length]), pa.int32())
            held = pa.ListArray.from_arrays(at, pa.array(np.frombuffer(b"".join(parts), np.int32)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(row, pa.int64())), pa.array(key + np.arange(len(row)), pa.int64()), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), held], [id_col, "_key", "piece", "start", "length", "ids"])
            key += len(row)

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, {PIECES}")


class BestFit:
    """Bounded-space online best-fit. ``put(n)`` gives the bin of a piece of ``n`` and the place in it."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins, self.free, self.open, self.made = capacity, open_bins, 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, n: int) -> tuple[int, int]:
        fits = self.free >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.open >= self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)
            space, number = self.capacity, self.made
            self.made += 1
        if space > n:
            self.bins[space - n].append(number)
            self.free |= 1 << (space - n)
            self.open += 1
        return number, self.capacity - space

    def _take(self, space: int) -> int:
        number = self.bins[space].pop()
        self.open -= 1
        if not self.bins[space]:
            self.free ^= 1 << space
        return number


def best_fit(items: DataFrame, limit: int, length: str = "length", open_bins: int = 4096,
             group_rows: int = 100_000) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``; ``items`` should be stored, as it is read twice."""
    order = [F.col(length).desc(), *[F.col(c) for c, t in items.dtypes if c != length and not t.startswith("map")]]
    groups = max(1, math.ceil(items.count() / group_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = BestFit(limit, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            put = [bins.put(n) for n in batch.column(length).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + b for b, _ in put], pa.int64()), pa.array([o for _, o in put], pa.int64())],
                [*batch.schema.names, "sequence_id", "offset"])

    dealt = items.repartition(groups).sortWithinPartitions(*order)
    schema = ", ".join(f"`{c}` {t}" for c, t in items.dtypes)
    return dealt.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def checksums(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """``packed`` with ``ids_crc32``: the CRC-32 of a row's ids as little-endian 32-bit words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            values, at = column.values.to_numpy().astype("<i4", copy=False), column.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(crc, pa.int64())], [*batch.schema.names, "ids_crc32"])

    return packed.mapInArrow(run, ", ".join(f"`{c}` {t}" for c, t in packed.dtypes) + ", ids_crc32 long")


def digests(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """As :func:`checksums`, without the ids themselves, which then need not leave the Python worker."""
    names = [c for c in rows.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(names))
            values, at = column.values.to_numpy().astype("<i4", copy=False), column.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(crc, pa.int64())], [*names, "ids_crc32"])

    return rows.select(*names, ids).mapInArrow(run, ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names) + ", ids_crc32 long")


def placed_pieces(docs: DataFrame, limit: int = 2048, path: str | None = None, id_col: str = "doc_id", text: str = "text",
                  open_bins: int = 4096, group_rows: int = 100_000) -> DataFrame:
    """Documents cut and packed: one row a piece with its ids, see :func:`token_pieces` and :func:`best_fit`."""
    held = stage(token_pieces(docs, limit, id_col, text, path), "pieces")
    places = best_fit(held.select("_key", "length"), limit, open_bins=open_bins, group_rows=group_rows).drop("length")
    # The places are some bytes a row, the ids thousands: the join builds its table of the former and need not sort the latter.
    packed = held.join(places.hint("shuffle_hash"), "_key")
    return packed.select(id_col, "piece", "start", "length", "sequence_id", "offset", "ids")


def pack(docs: DataFrame, limit: int = 2048, path: str | None = None, id_col: str = "doc_id", text: str = "text",
         open_bins: int = 4096, group_rows: int = 100_000) -> DataFrame:
    """:func:`placed_pieces` with the checksum of the ids of each."""
    packed = checksums(placed_pieces(docs, limit, path, id_col, text, open_bins, group_rows))
    return packed.select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")


@query("op5_best_fit_packing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens: where each piece lies, and the checksum of the ids packed there."""
    return digests(placed_pieces(read(spark, folder, "documents")))
