"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding.

Folding maps look-alike letters of other scripts, accents, and digits or marks that stand for letters to plain letters; i, l, 1
and | become one letter, as do o and 0. Texts and lexicon are folded alike, so ``1d10t`` meets ``idiot``.

The lexicon is learned: folded words, and beginnings of words, that labelled toxic documents have and others lack, each with its
log odds. Words next to a term that are seen with it only in other documents make exception phrases, which cancel the term where
they occur. Counts are made by tasks and added by a shuffle. A logistic curve over three figures (weight, weight by length,
strongest term) turns matches into a score from 0 to 1.

Labelled rows used to learn: at most ``SAMPLE_ROWS``, those with the lowest hash of their id; their ids, the lexicon and the curve,
which are bounded by it, go to all tasks. Scoring reads whole texts and shuffles nothing.

Cases: null and empty texts get the score of a text without terms; repeated rows get equal scores; without labels of both
kinds the lexicon is empty and every score is the share of toxic labels (0 without labels); an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import pieces, query, read

SAMPLE_ROWS = 60_000
#: A term is in at least so many toxic documents, and its share of them lies so many standard errors above its share of the others.
MIN_DOCS, MIN_Z = 4, 6.0
STEMS = range(4, 9)
THRESHOLD = 0.7

# Letters of other scripts that look like Latin ones, and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "н": "h", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ø": "o", "ß": "ss", "æ": "ae", "œ": "oe", "đ": "d", "ł": "l",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "|": "i", "!": "i", "+": "t", "€": "e"}
ONE = {"l": "i"}
_INSIDE = re.compile(r"(?<=[^\W_])[@$|!+€](?=[^\W_])|(?<![^\s])[@$€](?=[^\W_])")
_NUMBER = re.compile(r"(?<![^\W])\d[\d.,:/-]*(?![^\W])")


class _Letters(dict):
    """What a character becomes: a letter or two, nothing (combining marks), or a blank."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        out = "".join(HOMOGLYPHS.get(x, SIGNS.get(x, x)) for x in unicodedata.normalize("NFKD", c).lower())
        out = "".join(ONE.get(x, x) for x in out if not unicodedata.combining(x))
        out = out if all(x.isalpha() for x in out) else " "
        if len(self) < 200_000:
            self[code] = out
        return out


_letters = _Letters({ord(s): " " for s in "@$|!+€"})


def fold(text: str) -> str:
    """Plain letters and single words; signs count as letters inside a word or before one, numbers are left out."""
    if _NUMBER.search(text):
        text = _NUMBER.sub(" ", text)
    text = _INSIDE.sub(lambda m: SIGNS[m[0]], text)
    return text.translate(_letters)


def words_of(text: str) -> list[str]:
    return fold(text).split()


def _training(docs: DataFrame, labels: DataFrame, sample_rows: int, id_col: str, text: str, label: str) -> DataFrame:
    chosen = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label")).orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample_rows)
    return docs.select(F.col(id_col).alias("_doc"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_label", "_text")


def _counted(rows: DataFrame, make) -> DataFrame:
    """``make(text)`` counts strings; for each, toxic and other documents that have it, and how often they do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counter() for _ in range(4)]  # documents of the others, toxic ones; finds in the others, in toxic ones

        def flush():
            terms = list(held[0].keys() | held[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), *[pa.array([held[k][t] for t in terms], pa.int64()) for k in (1, 0, 3, 2)]],
                ["term", "toxic", "other", "in_toxic", "in_other"])
            for h in held:
                h.clear()
            return out

        for batch in pieces(batches):
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = make(text or "")
                held[label == 1].update(found.keys())
                held[2 + (label == 1)].update(found)
            if len(held[0]) + len(held[1]) > 300_000:
                yield flush()
        yield flush()

    kinds = ["toxic", "other", "in_toxic", "in_other"]
    return rows.mapInArrow(run, "term string, " + ", ".join(f"{k} long" for k in kinds)).groupBy("term").agg(
        *[F.sum(k).alias(k) for k in kinds])


class Lexicon:
    """Terms with weights (``word`` or ``stem*``), exception phrases (pairs of words), and the curve's four numbers."""

    def __init__(self, weights: dict[str, float], exceptions: set[tuple[str, str]] = frozenset(), curve=(0.0, 0.0, 0.0, 0.0)):
        self.weights, self.exceptions, self.curve = weights, set(exceptions), tuple(curve)
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    @property
    def automaton(self):
        import ahocorasick

        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for term, w in self.weights.items():
                key = " " + (term[:-1] if term.endswith("*") else term + " ")
                self._automaton.add_word(key, (len(key), term, w))
            for a, b in self.exceptions:
                self._automaton.add_word(f" {a} {b} ", (len(a) + len(b) + 3, None, 0.0))
            self._automaton.make_automaton()
        return self._automaton

    def hits(self, found: list[str]) -> list[tuple[str, float]]:
        """Terms in a text given as folded words, the strongest of each word, without those inside an exception phrase."""
        body, best, spared = f" {' '.join(found)} ", {}, []
        if not self.weights:
            return []
        for end, (size, term, w) in self.automaton.iter(body):
            start = end - size + 1  # the blank before the first word
            if term is None:
                spared.append((start, end))
            elif start not in best or w > best[start][1]:
                best[start] = (term, w)
        return [v for s, v in best.items() if not any(a <= s < b for a, b in spared)]

    def figures(self, text: str) -> tuple[float, float, float]:
        found = words_of(text)
        weights = [w for _, w in self.hits(found)]
        total = sum(weights)
        return math.log1p(total), min(5.0, 100.0 * total / (50.0 + len(found))), max(weights, default=0.0)

    def score(self, text: str) -> float:
        z = self.curve[0] + sum(c * f for c, f in zip(self.curve[1:], self.figures(text)))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def _terms(text: str) -> Counter:
    """Words, beginnings of words, and ``""`` for the number of words."""
    out = Counter()
    for w, n in Counter(words_of(text)).items():
        out[w] += n
        out[""] += n
        for k in STEMS:
            if len(w) >= k:
                out[w[:k] + "*"] += n
    return out


def choose_terms(counts: list[tuple[str, int, int, int, int]], toxic: int, other: int, words: tuple[int, int]) -> dict[str, float]:
    """Weights of the terms to keep: the log ratio of how often they occur. Of terms that begin alike the most telling one stays."""
    ranked = []
    for term, p, n, in_toxic, in_other in counts:
        both = (p + n) / (toxic + other)
        z = (p / toxic - n / other) / math.sqrt(max(both * (1 - both), 1e-9) * (1 / toxic + 1 / other))
        if z >= MIN_Z:
            ranked.append((-z, term.endswith("*"), -len(term), term, math.log((in_toxic + 0.5) / words[0]) - math.log((in_other + 0.5) / words[1])))
    weights: dict[str, float] = {}
    starts: set[str] = set()  # beginnings of kept terms
    for _, stem, _, term, weight in sorted(ranked):
        word = term.rstrip("*")
        if any(word[:k] + "*" in weights for k in range(1, len(word) + 1)) or (stem and word in starts):
            continue
        if weight > 0:
            weights[term] = weight
            starts |= {word[:k] for k in range(1, len(word) + 1)}
    return weights


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 60, ridge: float = 1e-2) -> tuple[float, ...]:
    """Logistic regression by Newton's method; no weight but the first may be below zero."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w = w + step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        w[1:] = np.maximum(w[1:], 0.0)
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Lexicon:
    """A lexicon from the labelled documents of ``labels``."""
    rows = _training(docs, labels, sample_rows, id_col, text, label)
    of = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    toxic, other = of.get(1, 0), sum(n for k, n in of.items() if k != 1)
    if not toxic or not other:
        return Lexicon({}, (), (math.log((toxic + 1e-9) / (other + 1e-9)) if toxic or other else -30.0, 0.0, 0.0, 0.0))
    counted = _counted(rows, _terms).where((F.col("toxic") >= MIN_DOCS) & (F.col("toxic") / toxic > 2 * F.col("other") / other) | (F.col("term") == ""))
    counts = {r["term"]: tuple(r) for r in counted.collect()}
    total = counts.pop("", ("", 0, 0, 1, 1))
    weights = choose_terms(list(counts.values()), toxic, other, (max(1, total[3]), max(1, total[4])))
    plain = Lexicon(weights)

    def phrases(body: str) -> Counter:
        found, out = words_of(body), Counter()
        known = {t for t, _ in plain.hits(found)}
        if known:
            stems = tuple(t[:-1] for t in known if t.endswith("*"))
            for i, w in enumerate(found):
                if w in known or (stems and w.startswith(stems)):
                    out.update(f"{a} {b}" for a, b in zip(found[max(0, i - 1):i + 1], found[max(1, i):i + 2]))
        return out

    spared = _counted(rows, phrases).where((F.col("toxic") == 0) & (F.col("other") >= MIN_DOCS)).collect()
    lexicon = Lexicon(weights, {tuple(r["term"].split(" ")) for r in spared if r["term"].count(" ") == 1})
    kind = "label long, " + ", ".join(f"f{k} double" for k in range(3))

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            f = [lexicon.figures(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *[pa.array([v[k] for v in f], pa.float64()) for k in range(3)]],
                                             ["label", "f0", "f1", "f2"])

    sample = rows.mapInArrow(figures, kind).collect()  # at most sample_rows
    x = np.array([[r["f0"], r["f1"], r["f2"]] for r in sample])
    lexicon.curve = fit_curve(x, np.array([float(r["label"] == 1) for r in sample]))
    return lexicon


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col`` and ``score`` of every row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [lexicon.score(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], [id_col, "score"])

    return docs.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, score double")


def fold_of(id_col: str, folds: int):
    """CRC32 of the id as text, modulo ``folds``; a null id counts as empty."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


@query("op9_lexicon_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document, learned from the labels outside the held-out third."""
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    found = score(docs, learn(docs, labels.where(fold_of("doc_id", 3) != 1)))
    return found.select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score",
                        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
