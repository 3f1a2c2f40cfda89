"""Quality by perplexity under an interpolated modified Kneser-Ney model of byte n-grams, trained on trusted text.

Byte n-grams need no vocabulary: junk is strange in its letters, marks and spacing, and new words of good prose are not. Trusted
documents are all those with a good label. Four fifths of them train
the model; the others give, for each language, the quantiles of perplexity between which a document is kept. A quantile ``q`` needs
``1 / q`` documents to have one beyond it (``1 / (1 - q)`` above): a language with so many of the other fifth is judged by its own, and one with fewer by
the distance that the quantiles of all languages have from their medians, if that is wider.

The model is made by grouping and joining, spread by n-gram: counts of the longest n-grams; for shorter ones the number of
different bytes before them; three discounts an order from counts of counts; and, from short to long, each probability joined with
that of its suffix and the weight of its context. Scoring a text position needs one row where the n-gram is known, else the
weights of the contexts that are, and the row of a shorter one. Joining all positions by a shuffle would move more than ten times the text, so the model
goes to the tasks instead, one shard of at most ``SHARD_ROWS`` rows at a time; n-grams of a shard share the hash of their context's last two
bytes, so all rows that a position may need are in one shard. With several shards the texts are written with a row key first, by which partial sums are added.

Cases: null and empty texts have no bytes, perplexity 1, and are not kept; repeated rows are judged alike; without trusted documents
every text is kept but those; a language without trusted documents, or a null one, is judged by the quantiles of all; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .base import pieces, query, read, utf8
from .tokens import mix

ORDER = 5
SHARD_ROWS = 4_000_000
QUANTILES = (0.002, 0.995)
PAD = b"\n" * (ORDER - 1)
_BLANK = bytes(32 if b in range(9, 14) else b for b in range(256))


def grams(texts: list[bytes], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For every byte of the texts, the n-grams that end there (1 to ``order``, as integers), and the number of its text."""
    data = np.frombuffer(b"".join(PAD + t.translate(_BLANK) for t in texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size + len(PAD)) - size
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
    out, g = [], np.zeros(len(at), np.uint64)
    for n in range(order):
        g = g | (data[at - n].astype(np.uint64) << np.uint64(8 * n))
        out.append(g)
    return out, np.repeat(np.arange(len(texts)), size)


def gram_counts(docs: DataFrame, text: str) -> DataFrame:
    """The longest n-grams ``g`` and their counts ``c``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in pieces(batches, 500):
            held.append(np.unique(grams(utf8(batch.column(0)), ORDER)[0][-1], return_counts=True))
            rows += len(held[-1][0])
            if rows > 2_000_000:
                held = [_added(held)]
                rows = len(held[0][0])
                if rows > 1_000_000:
                    yield _batch(*held.pop())
                    rows = 0
        if held:
            yield _batch(*_added(held))

    return docs.select(text).mapInArrow(run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by n-gram."""
    g, c = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(g, kind="stable")  # runs in order are merged
    g, c = g[order], c[order]
    first = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
    return g[first], np.add.reduceat(c, first) if len(g) else c


def _batch(g: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(c.astype(np.int64))], ["g", "c"])


def _discounts(counts: DataFrame) -> list[float]:
    """Of n-grams seen once, twice, and more often."""
    n = dict(counts.where("c <= 4").groupBy("c").agg(F.count("*").alias("n")).collect())
    n1, n2, n3, n4 = (n.get(k, 0) for k in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    part = lambda k, a, b: min(k, max(0.05, k - (k + 1) * y * b / a)) if a else 0.5 * k
    return [part(1, n1, n2), part(2, n2, n3), part(3, n3, n4)]


def train(docs: DataFrame, text: str = "text") -> DataFrame:
    """The model: ``n`` (length), ``g``, and ``p`` (natural log probability); context weights have ``n`` below zero."""
    counts = {ORDER: stage(gram_counts(docs, text), "grams")}
    for n in range(ORDER - 1, 0, -1):
        mask = (1 << 8 * n) - 1
        counts[n] = stage(counts[n + 1].groupBy(F.col("g").bitwiseAND(F.lit(mask)).alias("g")).agg(F.count("*").alias("c")), "grams")
    below = model = None
    for n in range(1, ORDER + 1):
        d = _discounts(counts[n])
        context = F.shiftright("g", 8).alias("h")
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        weights = counts[n].groupBy(context).agg(F.sum("c").alias("all"), F.sum(off).alias("off")).select(
            "h", "all", (F.col("off") / F.col("all")).alias("weight"))
        rows = counts[n].withColumn("h", F.shiftright("g", 8)).join(weights, "h")
        if n == 1:
            shorter = F.lit(1 / 256)
        else:
            rows = rows.withColumn("s", F.col("g").bitwiseAND(F.lit((1 << 8 * (n - 1)) - 1))).join(below, "s")
            shorter = F.col("q")
        rows = rows.select("g", "h", ((F.col("c") - off) / F.col("all") + F.col("weight") * shorter).alias("q"))
        rows = stage(rows, "model")
        below = rows.select(F.col("g").alias("s"), "q")
        part = rows.select(F.lit(n).alias("n"), "g", F.log("q").alias("p")).union(
            weights.select(F.lit(-n).alias("n"), F.col("h").alias("g"), F.log("weight").alias("p")))
        model = part if model is None else model.union(part)
    return stage(model, "model")


class Rows:
    """N-grams and their numbers in an open hash table."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, np.nan, np.float32)
        left = np.arange(len(keys))
        place = self._home(keys)
        while len(left):
            free = self.keys[place[left]] == 0
            self.keys[place[left[free]]] = keys[left[free]]  # of several for one place the last stays
            done = self.keys[place[left]] == keys[left]
            self.values[place[left[done]]] = values[left[done]]
            left = left[~done]
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, NaN where there is none."""
        out = np.full(len(keys), np.nan, np.float32)
        left, place = np.arange(len(keys)), self._home(keys)
        while len(left):
            found = self.keys[place]
            hit = found == keys[left]
            out[left[hit]] = self.values[place[hit]]
            on = ~hit & (found != 0)
            left, place = left[on], (place[on] + 1) & ((1 << self.bits) - 1)
        return out


def _key(n: int, g: np.ndarray) -> np.ndarray:
    """A number for an n-gram of length ``n``, or for the weight of a context (``n`` below zero); never zero."""
    return g | (np.uint64(n if n > 0 else 8 - n) << np.uint64(56))


def _shard(g2: np.ndarray, shards: int) -> np.ndarray:
    return (mix(g2 + np.uint64(1)) % np.uint64(shards)).astype(np.int64)


def log_probability(texts: list[bytes], rows: Rows, shard: int = 0, shards: int = 1) -> np.ndarray:
    """Natural log probability of the bytes of each text whose context is in ``shard``."""
    g, of = grams(texts, ORDER)
    if shards > 1:
        own = _shard((g[2] >> np.uint64(8)), shards) == shard
        g, of = [x[own] for x in g], of[own]
    total = np.zeros(len(of))
    left = np.arange(len(of))
    for n in range(ORDER, 0, -1):
        p = rows.find(_key(n, g[n - 1][left]))
        hit = ~np.isnan(p)
        total[left[hit]] += p[hit]
        left = left[~hit]
        if not len(left):
            break
        total[left] += np.nan_to_num(rows.find(_key(-n, g[n - 1][left] >> np.uint64(8))))  # an unseen context has weight 1
        if n == 1:
            total[left] += math.log(1 / 256)
    return np.bincount(of, total, len(texts))


def model_shards(model: DataFrame, shard_rows: int) -> Iterator[tuple[Rows, int, int]]:
    """The model in parts of about ``shard_rows`` rows; short n-grams, at most 2 * 256 ** 2 rows, are in every part."""
    shards = max(1, -(-model.count() // shard_rows))
    # the last two bytes of the context: of a row of n bytes the second and third from its end, of a weight the last two
    pair = F.when(F.col("n") > 0, F.shiftright("g", 8)).otherwise(F.col("g")).bitwiseAND(F.lit(0xFFFF))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = _shard(batch.column(3).to_numpy().astype(np.uint64), shards)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(s)], ["n", "g", "p", "shard"])

    placed = model.select("n", "g", "p", pair.alias("pair")).mapInArrow(own, "n int, g long, p double, shard long")
    for s in range(shards):
        keys, values = [], []
        mine = placed.where((F.col("shard") == s) | F.col("n").between(-2, 2)).select("n", "g", "p")
        for r in mine.mapInArrow(_packed, "k binary, v binary").toLocalIterator():
            keys.append(np.frombuffer(r["k"], np.uint64))
            values.append(np.frombuffer(r["v"], np.float32))
        yield Rows(np.concatenate(keys or [np.zeros(0, np.uint64)]), np.concatenate(values or [np.zeros(0, np.float32)])), s, shards


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, g, p = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        g = g.astype(np.uint64)
        keys = g | (np.where(n > 0, n, 8 - n).astype(np.uint64) << np.uint64(56))
        yield pa.RecordBatch.from_arrays([pa.array([keys.tobytes()], pa.binary()), pa.array([p.astype(np.float32).tobytes()], pa.binary())], ["k", "v"])


def perplexity(docs: DataFrame, model: list, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with ``n_bytes``, ``log10_p`` and ``perplexity`` (of a byte); ``model``: broadcast parts."""
    keep = [c for c in docs.columns if c != text]
    rows_of = docs.select(*keep, text)
    if len(model) > 1:
        rows_of = stage(rows_of.withColumn("_row", F.monotonically_increasing_id()).select(*keep, "_row", text), "rows")
    held = rows_of.columns[:-1]
    schema = ", ".join(f"`{c}` {rows_of.schema[c].dataType.simpleString()}" for c in held)

    def part(rows, shard: int, shards: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches, 250):
                texts = utf8(batch.column(len(held)))
                p = log_probability(texts, rows.value, shard, shards)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([len(t) for t in texts], pa.int64()), pa.array(p)], [*held, "n_bytes", "_p"])

        return rows_of.mapInArrow(run, f"{schema}, n_bytes long, _p double")

    parts = [part(*m) for m in model]
    out = parts[0]
    for k, more in enumerate(parts[1:]):
        out = out.join(more.select("_row", F.col("_p").alias(f"_p{k}")), "_row").withColumn("_p", F.col("_p") + F.col(f"_p{k}")).drop(f"_p{k}")
    return out.select(*keep, "n_bytes", (F.col("_p") / math.log(10)).alias("log10_p"),
                      F.exp(-F.col("_p") / F.greatest(F.col("n_bytes"), F.lit(1))).alias("perplexity"))


def exact_quantiles(rows: DataFrame, by: str, value: str, wanted: dict[str, float], cells: int = 1000) -> DataFrame:
    """A row a group: the number of its rows, and the quantiles, interpolated as ``percentile`` does.

    Rows are counted in cells of ``1 / cells`` first; only values of the cells that hold a wanted place are put in order, so no
    group is held whole.
    """
    values = rows.groupBy(by, value).agg(F.count("*").alias("_n")).withColumn("_cell", F.floor(F.col(value) * cells))
    group = Window.partitionBy(by)
    counts = values.groupBy(by, "_cell").agg(F.sum("_n").alias("_here")).withColumns({
        "held": F.sum("_here").over(group),
        "_upto": F.sum("_here").over(group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))})
    place = {k: (F.col("held") - 1) * F.lit(float(q)) for k, q in wanted.items()}
    ends = {k: (F.floor(p), F.ceil(p)) for k, p in place.items()}
    hit = F.lit(False)
    for r in (r for pair in ends.values() for r in pair):
        hit = hit | ((F.col("_upto") > r) & (F.col("_upto") - F.col("_here") <= r))
    at = counts.where(hit).select(F.col(by).alias("_by"), F.col("_cell").alias("_hit"), "held", (F.col("_upto") - F.col("_here")).alias("_before"))
    near = values.join(at, F.col(by).eqNullSafe(F.col("_by")) & F.col("_cell").eqNullSafe(F.col("_hit")))
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy("_by", "_hit").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    found = near.withColumn("_upto", upto).groupBy("_by", "held").agg(*[
        F.min(F.when(F.col("_upto") > r, F.col(value))).alias(f"_{k}{i}") for k, pair in ends.items() for i, r in enumerate(pair)])

    def between(k: str):
        low, high, (a, b) = F.col(f"_{k}0"), F.col(f"_{k}1"), ends[k]
        return F.when(low == high, low).otherwise((b - place[k]) * low + (place[k] - a) * high)

    return found.select(F.col("_by").alias(by), "held", *[between(k).alias(k) for k in wanted])


def classify(docs: DataFrame, labels: DataFrame, quantiles: tuple[float, float] = QUANTILES,
             shard_rows: int = SHARD_ROWS, id_col: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "quality") -> DataFrame:
    """Perplexity of every document, the bounds of its language, and whether it is ``kept``."""
    spark = docs.sparkSession
    good = labels.where((F.col(label) == 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id")).distinct()
    trusted = docs.select(F.col(id_col).alias("_doc"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).join(
        good.hint("merge"), F.col("_doc") == F.col("_id"))  # the set of ids has no bound, so no plan may rest on sending it to all tasks
    fifth = F.crc32(F.col("_id").cast("string").cast("binary")) % 5
    model = [(spark.sparkContext.broadcast(rows), s, n) for rows, s, n in model_shards(train(trusted.where(fifth != 0), "_text"), shard_rows)]
    held = perplexity(trusted.where(fifth == 0).select("_lang", "_text"), model, "_text")
    held = stage(held.where("n_bytes > 0").select("_lang", F.log("perplexity").alias("_x")), "calibration")
    tails = dict(zip(("low", "high"), quantiles))
    by_lang = stage(exact_quantiles(held, "_lang", "_x", {"mid": 0.5, **tails}), "quantiles").withColumnRenamed("_lang", "_of")
    apart = held.join(by_lang.select("_of", "mid"), F.col("_lang").eqNullSafe(F.col("_of"))).select((F.col("_x") - F.col("mid")).alias("_x"))
    pooled, everywhere = (exact_quantiles(rows.withColumn("_lang", F.lit(0)), "_lang", "_x", tails).first() or dict.fromkeys(tails) for rows in (apart, held))
    enough = [F.col("held") >= math.ceil(round(1 / q, 6)) for q in (quantiles[0], 1 - quantiles[1])]
    wide = [F.col("mid") + F.lit(pooled[k]).cast("double") for k in ("low", "high")]
    by_lang = by_lang.where("_of is not null").select(
        "_of", F.exp(F.when(enough[0], F.col("low")).otherwise(F.least("low", wide[0]))).alias("low"),
        F.exp(F.when(enough[1], F.col("high")).otherwise(F.greatest("high", wide[1]))).alias("high"))
    rows = perplexity(docs.select(id_col, F.col(lang).alias("_lang"), text), model, text)
    out = rows.join(by_lang, F.col("_lang") == F.col("_of"), "left")
    low = F.coalesce("low", F.lit(math.exp(everywhere["low"]) if everywhere["low"] is not None else 0.0))
    high = F.coalesce("high", F.lit(math.exp(everywhere["high"]) if everywhere["high"] is not None else float("inf")))
    return out.select(id_col, "n_bytes", "log10_p", "perplexity", low.alias("low"), high.alias("high"),
                      ((F.col("n_bytes") > 0) & F.col("perplexity").between(low, high)).alias("kept"))


@query("op8_kneser_ney_quality")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    return classify(read(spark, folder, "documents"), read(spark, folder, "labels"))
