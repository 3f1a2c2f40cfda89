"""SimHash near-duplicates: fingerprints linked by BK-trees, one tree for each shard of fingerprints.

A BK-tree keeps the children of a node by their Hamming distance to it; a search within radius ``r`` of a query at distance
``d`` from a node follows the edges ``d-r`` to ``d+r`` only. One tree over all fingerprints would visit a large part of
itself for every query and could not be held or broadcast at scale. Here the 64 bits are cut into four blocks: two
fingerprints that differ in at most two bits agree in at least two blocks, so the pair meets in one of the six shards named by two block
values, and each shard has a tree of its own. A shard of more than ``tree_rows`` fingerprints is cut again in the same
way by its other 32 bits; what is then in a shard shares 48 bits, so no tree can have more than 65,536 nodes. Nothing is dropped and nothing is
broadcast. A tree yields one link from each fingerprint to the lowest one that its links reach in that shard; components
over these links are the components over all pairs.

Cases: null and empty texts have fingerprint zero, linked like any other; repeated rows and equal texts are one fingerprint; a
null id takes part, links others too, and is never the name of a component unless there is no other; extra columns are not read by
:func:`near_duplicates`, and kept by :func:`keep_first_row` and :func:`keep_first`, for which names that start with ``_dup_`` are their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .base import pieces, query, read, utf8, words
from .components import connected_components

SEED, CHUNK = 42, 1 << 16


def fingerprint(tokens: list[bytes], length: int = 3, seed: int = SEED) -> int:
    """Bit ``i`` is 1 if it is set in over half of the shingles' XXH64; no tokens: zero."""
    if not tokens:
        return 0
    n, digest = max(1, len(tokens) - length + 1), xxhash.xxh64_digest
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, CHUNK):
        part = tokens[start:min(n, start + CHUNK) + length - 1]
        shingles = zip(*[part[i:] for i in range(length)]) if len(tokens) >= length else [part]
        digests = b"".join([digest(b" ".join(s), seed) for s in shingles])
        ones += np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, length: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col`` and ``fp``, the fingerprint as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = np.array([fingerprint(words(t), length) for t in utf8(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], [id_col, "fp"])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, fp long")


class BKTree:
    """Integers under Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def within(self, value: int, radius: int) -> list[int]:
        """Numbers of the nodes at most ``radius`` bits away."""
        found, todo = [], [0] if self.values else []
        values, children = self.values, self.children
        while todo:
            node = todo.pop()
            d = (values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            below = children[node]
            if below:
                todo += [below[k] for k in range(d - radius, d + radius + 1) if k in below]
        return found

    def add(self, value: int) -> int:
        """Insert; the number of the new node."""
        new = len(self.values)
        node = 0
        while new:
            d = (self.values[node] ^ value).bit_count()
            if d not in self.children[node]:
                self.children[node][d] = new
                break
            node = self.children[node][d]
        self.values.append(value)
        self.children.append({})
        return new


def tree_links(values: list[int], names: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """For each value that has links in this shard: its name, and the lowest name that they reach."""
    tree, root = BKTree(), list(range(len(values)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, value in enumerate(values):
        for j in tree.within(value, radius):
            x, y = top(i), top(j)
            if x != y:
                root[x if names[y] < names[x] else y] = y if names[y] < names[x] else x
        tree.add(value)
    return ((names[i], names[top(i)]) for i in range(len(values)) if top(i) != i)


def _blocks(fp: Column, bits: list[int]) -> list[tuple[Column, list[int]]]:
    """Two of four blocks of the given bit positions, in all six ways: their value, and the bits that are left."""
    size = len(bits) // 4
    parts = [bits[i * size:(i + 1) * size] for i in range(4)]

    def value(chosen: tuple[int, ...]) -> Column:
        mask = sum(1 << b for i in chosen for b in parts[i])
        return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))

    return [(value(c), [b for i in range(4) if i not in c for b in parts[i]]) for c in combinations(range(4), 2)]


def _shards(nodes: DataFrame, tree_rows: int) -> DataFrame:
    """Each fingerprint in its shards of at least two: ``shard``, ``fp``, ``name``."""
    six = _blocks(F.col("fp"), list(range(64)))
    one = nodes.select("fp", "name", F.explode(F.array(*[
        F.struct(F.lit(i).alias("way"), v.alias("value")) for i, (v, _) in enumerate(six)])).alias("s")).select("fp", "name", "s.*")
    held = one.groupBy("way", "value").agg(F.count("*").alias("_n")).where("_n > 1")
    one = stage(one.join(held, ["way", "value"]), "shards")
    again = None
    for i, (_, rest) in enumerate(six):
        keys = F.array(*[F.struct(F.lit(i * 6 + k).alias("sub"), v.alias("value2")) for k, (v, _) in enumerate(_blocks(F.col("fp"), rest))])
        again = F.when(F.col("way") == i, keys) if again is None else again.when(F.col("way") == i, keys)
    hot = one.where(F.col("_n") > tree_rows).withColumn("s", F.explode(again))
    hot = hot.select(F.struct("way", "value", F.col("s.sub").alias("sub"), F.col("s.value2").alias("value2")).alias("shard"), "fp", "name")
    cold = one.where(F.col("_n") <= tree_rows).select(F.struct(
        "way", "value", F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("value2")).alias("shard"), "fp", "name")
    return cold.union(hot)


def link_fingerprints(nodes: DataFrame, radius: int = 2, tree_rows: int = 1024) -> DataFrame:
    """Links ``a``, ``b`` between the names of distinct fingerprints (``fp``, ``name``) at most ``radius`` bits apart.

    Not every pair, but enough to connect all that the pairs connect.
    """
    if radius > 2:
        raise ValueError("two of four blocks agree for a radius of 2 at most")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(values, names):
            return list(tree_links(values, names, radius)) if len(values) > 1 else []

        shard, values, names = None, [], []
        for batch in batches:
            links = []
            key = zip(*[batch.column(0).field(i).to_pylist() for i in range(4)])
            for k, fp, name in zip(key, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if k != shard:
                    links += flush(values, names)
                    shard, values, names = k, [], []
                values.append(fp & 0xFFFFFFFFFFFFFFFF)
                names.append(name)
            yield _edges(links)
        yield _edges(flush(values, names))

    dealt = _shards(nodes, tree_rows).repartition("shard").sortWithinPartitions("shard", "name")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def _edges(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])


def near_duplicates(docs: DataFrame, length: int = 3, radius: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document: its id, ``fp``, and ``component_id``, the lowest id that links reach. Ids are integers."""
    prints = stage(fingerprints(docs, length, id_col, text), "fingerprints")
    nodes = stage(prints.groupBy("fp").agg(F.min(F.col(id_col).cast("long")).alias("name")), "nodes")
    row = nodes.agg(F.max("name").alias("top"), F.count_if(F.col("name").isNull()).alias("unnamed")).first()
    top = -1 if row["top"] is None else row["top"]
    if row["unnamed"]:  # fingerprints of null ids alone link too, under names above all ids
        nodes = stage(nodes.withColumn("name", F.coalesce("name", F.lit(top).cast("long") + 1 + F.monotonically_increasing_id())), "nodes")
    links = link_fingerprints(nodes, radius)
    found = connected_components(links, "a", "b")
    name = F.coalesce("component", "name")
    of = nodes.join(found, nodes["name"] == found["node"], "left").select("fp", F.when(name <= top, name).alias("component_id"))
    return prints.join(of, "fp").select(id_col, "fp", "component_id")


def keep_first_row(docs: DataFrame, length: int = 3, radius: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that of the lowest id, null ids last.

    Rows are told apart by a key of their own, not by id: rows that share an id, or have none, stand or fall each by its text.
    """
    rows = stage(docs.withColumn("_dup_row", F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows, length, radius, "_dup_row", text).select("_dup_row", "component_id")
    rank = F.struct(F.col("_dup_id").isNull().alias("none"), "_dup_id", "_dup_row")
    first = found.join(rows.select("_dup_row", F.col(id_col).alias("_dup_id")), "_dup_row").groupBy("component_id").agg(F.min(rank).alias("_dup_first"))
    return rows.join(first.select(F.col("_dup_first._dup_row").alias("_dup_row")), "_dup_row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_first(docs: DataFrame, length: int = 3, radius: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The document of the lowest id of each component, with all its columns.

    Rows that repeat id and text collapse to one. Rows that share an id but not a text are kept or dropped together, and so are
    all rows of null ids; :func:`keep_first_row` decides row by row.
    """
    found = near_duplicates(docs, length, radius, id_col, text)
    ids = found.groupBy(F.col(id_col).alias("_dup_id")).agg(F.min("component_id").alias("_dup_first"), F.count("*").alias("_dup_rows"))
    kept = ids.where(F.col("_dup_id").eqNullSafe(F.col("_dup_first").cast(docs.schema[id_col].dataType)))
    rows = docs.join(kept.select("_dup_id", "_dup_rows"), docs[id_col].eqNullSafe(F.col("_dup_id")))
    again = Window.partitionBy("_dup_id", F.xxhash64(text)).orderBy("_dup_id")
    more = rows.where("_dup_rows > 1").withColumn("_dup_nr", F.row_number().over(again)).where("_dup_nr = 1").drop("_dup_nr")
    return rows.where("_dup_rows = 1").union(more).drop("_dup_id", "_dup_rows")


@query("op10_simhash_bk_tree")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
