"""Quality rules: decision lists learned by sequential covering, applied as ordered Spark conditional expressions.

Text statistics are built-in Spark functions only. A bounded sample of labelled rows (``SAMPLE_ROWS``) is reduced to such
statistics, and rules against documents of label 0 are grown from it one after another: a rule is a conjunction of thresholds,
each chosen by information gain on two thirds of the rows that no earlier rule covers, then cut back on the other third. Learning
ends when a new rule would reject too many good documents. The list becomes one ``when(...).when(...).otherwise(...)`` column.

Cases: a null or empty text has no words and fails the base rule; rows are judged alone, so repeated rows agree; unlabelled or
null labels teach nothing; without labels of both kinds the list is empty and keeps all. Tables may be empty. Extra columns
of the documents are kept by :func:`reject` and may have any name but those of ``STATISTICS`` with ``_q_`` before them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage
from .base import query, read

#: At most so many labelled rows are used to learn, those with the lowest hash of their id.
SAMPLE_ROWS = 20_000
BLANK = r"[\x20\x09-\x0D]+"
WINDOW = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def _count(text: Column, pattern: str) -> Column:
    return (F.size(F.split(text, pattern)) - 1).cast("long")


def repeated_words(hashes: Column) -> Column:
    """Words, given by their hashes, in windows of eight that are found twice or more; the first find counts too.

    Windows are hashed, and texts without an equal pair end there. Else hashes are sorted with their places, places with
    an equal neighbour are put in order, and the words they cover are added up: no step is quadratic in the text.
    """
    def covered(windows: Column) -> Column:
        places = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        doubled = let(places, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False))),
            lambda e: e["i"])))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(doubled, start, lambda a, p: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    return let(hashes, lambda h: F.when(F.size(h) > WINDOW, let(windows(h), lambda w: F.when(
        F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(F.lit(0).cast("long")))).otherwise(F.lit(0).cast("long")))


#: Counts of a text; the rules use their ratios.
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim", "n_digits", "n_bars")


def with_statistics(docs: DataFrame, text: str = "text", prefix: str = "_q_") -> DataFrame:
    """``docs`` with the ``STATISTICS`` as long columns; arrays of words are made once a row."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    made = docs.withColumns({
        f"{prefix}w": let(split_words(body), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(F.transform(w, lambda x: F.xxhash64(x))).alias("n_repeat_words"))),
        f"{prefix}l": let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))),
        f"{prefix}n_symbols": _count(body, "[#*$%&|<>]"), f"{prefix}n_upper": _count(body, r"\p{Lu}"),
        f"{prefix}n_exclaim": _count(body, "!"), f"{prefix}n_digits": _count(body, "[0-9]"), f"{prefix}n_bars": _count(body, r"\|"),
    })
    return made.withColumns({
        **{f"{prefix}{k}": F.col(f"{prefix}w")[k] for k in ("n_words", "word_chars", "n_repeat_words")},
        **{f"{prefix}{k}": F.col(f"{prefix}l")[k] for k in ("n_lines", "n_dup_lines")},
    }).drop(f"{prefix}w", f"{prefix}l")


def features(prefix: str = "_q_") -> dict[str, Column]:
    """What thresholds are put on: ratios, so that they hold for any length."""
    c = lambda k: F.col(f"{prefix}{k}").cast("double")
    words, chars, lines = F.greatest(c("n_words"), F.lit(1.0)), F.greatest(c("word_chars"), F.lit(1.0)), F.greatest(c("n_lines"), F.lit(1.0))
    return {
        "n_words": c("n_words"), "word_length": c("word_chars") / words, "symbols_per_word": c("n_symbols") / words,
        "dup_line_share": c("n_dup_lines") / lines, "repeat_share": c("n_repeat_words") / words, "words_per_line": c("n_words") / lines,
        "upper_share": c("n_upper") / chars, "exclaims_per_word": c("n_exclaim") / words, "digit_share": c("n_digits") / chars,
        "bars_per_word": c("n_bars") / words,
    }


@dataclass(frozen=True)
class Rule:
    """All of ``terms`` (feature, ``<=`` or ``>``, threshold) hold."""

    terms: tuple[tuple[str, str, float], ...]

    def mask(self, x: dict[str, np.ndarray]) -> np.ndarray:
        out = np.ones(len(next(iter(x.values()))), bool)
        for name, op, cut in self.terms:
            out &= x[name] <= cut if op == "<=" else x[name] > cut
        return out

    def column(self, of: dict[str, Column]) -> Column:
        out = F.lit(True)
        for name, op, cut in self.terms:
            out = out & (of[name] <= F.lit(cut) if op == "<=" else of[name] > F.lit(cut))
        return out

    def __str__(self) -> str:
        return " and ".join(f"{n} {o} {c:.6g}" for n, o, c in self.terms)


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, cuts: dict[str, np.ndarray], max_terms: int) -> list[tuple[str, str, float]]:
    terms, inside = [], np.ones(len(bad), bool)
    while len(terms) < max_terms:
        p0, n0 = int(bad[inside].sum()), int((~bad[inside]).sum())
        if not p0 or not n0:
            break
        best, before = (0.0, None), math.log2(p0 / (p0 + n0))
        for name, values in x.items():
            order = np.searchsorted(cuts[name], values[inside], side="left")  # value <= cuts[k] for k >= order
            p = np.cumsum(np.bincount(order[bad[inside]], minlength=len(cuts[name]) + 1))
            n = np.cumsum(np.bincount(order[~bad[inside]], minlength=len(cuts[name]) + 1))
            for k, cut in enumerate(cuts[name]):
                for op, pp, nn in (("<=", p[k], n[k]), (">", p0 - p[k], n0 - n[k])):
                    if pp and pp + nn < p0 + n0:
                        gain = float(pp) * (math.log2(pp / (pp + nn)) - before)
                        if gain > best[0] + 1e-9:
                            best = (gain, (name, op, float(cut)))
        if best[1] is None:
            break
        terms.append(best[1])
        inside &= Rule((best[1],)).mask(x)
    return terms


def learn(x: dict[str, np.ndarray], bad: np.ndarray, max_rules: int = 12, max_terms: int = 4, min_precision: float = 0.9,
          min_rows: int = 3, cuts: int = 64) -> list[Rule]:
    """Rules against the rows of ``bad``, in the order in which they were learned. Nothing is random."""
    rules, left = [], np.ones(len(bad), bool)
    grow_row = np.arange(len(bad)) % 3 != 2
    while len(rules) < max_rules and bad[left].any():
        grow, check = left & grow_row, left & ~grow_row
        part = {k: v[grow] for k, v in x.items()}
        at = {k: np.unique(np.quantile(v, np.linspace(0, 1, cuts + 1)[:-1])) if len(v) else np.zeros(0) for k, v in part.items()}
        at = {k: np.unique(np.concatenate([v, np.quantile(part[k][bad[grow]], np.linspace(0, 1, 33))])) if bad[grow].any() else v for k, v in at.items()}
        terms = _grow(part, bad[grow], at, max_terms)
        held = {k: v[check] for k, v in x.items()}

        def worth(t: list) -> float:
            m = Rule(tuple(t)).mask(held)
            p, n = int((bad[check] & m).sum()), int((~bad[check] & m).sum())
            return (p - n) / (p + n) if p + n else -1.0

        while len(terms) > 1:
            best = max(range(len(terms)), key=lambda k: worth(terms[:k] + terms[k + 1:]))
            if worth(terms[:best] + terms[best + 1:]) < worth(terms):
                break
            terms = terms[:best] + terms[best + 1:]
        if not terms:
            break
        rule = Rule(tuple(terms))
        inside = rule.mask(x) & left
        if inside.sum() < min_rows or bad[inside].mean() < min_precision:
            break
        rules.append(rule)
        left &= ~inside
    return rules


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text: str = "text",
        label: str = "quality", **options) -> list[Rule]:
    """Rules from the labelled documents; ids and labels of the sample (at most ``sample_rows``) are sent to all tasks."""
    chosen = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label")).orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample_rows)
    # Stored, so that statistics are made of the sample alone: a condition on them would else be tried on every document first.
    rows = stage(docs.select(F.col(id_col).alias("_doc"), F.col(text).alias("_text")).join(
        F.broadcast(chosen), F.col("_doc") == F.col("_id")), "labelled")
    of = features()
    stats = with_statistics(rows, "_text").where(~base_failed()).select(
        "_id", "_label", *[v.alias(k) for k, v in of.items()]).orderBy(F.xxhash64("_id"), "_id", *of).limit(sample_rows).collect()
    if not stats:
        return []
    return learn({k: np.array([r[k] for r in stats], float) for k in of}, np.array([r["_label"] == 0 for r in stats]), **options)


def base_failed(prefix: str = "_q_") -> Column:
    words = F.col(f"{prefix}n_words")
    return (words < 20) | (100 * F.col(f"{prefix}n_repeat_words") > 30 * words)


def verdict(rules: list[Rule], prefix: str = "_q_") -> Column:
    """The number of the first rule that a row meets, 0 if it meets none."""
    of = features(prefix)
    if not rules:
        return F.lit(0)
    out = F.when(rules[0].column(of), 1)
    for i, rule in enumerate(rules[1:], 2):
        out = out.when(rule.column(of), i)
    return out.otherwise(0)


def judge(docs: DataFrame, rules: list[Rule], text: str = "text", prefix: str = "_q_") -> DataFrame:
    """``docs`` with statistics, ``base_failed``, ``rule`` and ``kept``, all named after ``prefix``."""
    out = with_statistics(docs, text, prefix).withColumn(f"{prefix}base_failed", base_failed(prefix))
    out = out.withColumn(f"{prefix}rule", verdict(rules, prefix))
    return out.withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & (F.col(f"{prefix}rule") == 0))


def reject(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns only."""
    return judge(docs, rules, text).where("_q_kept").select(*docs.columns)


@query("op6_decision_list_quality")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of every document, by rules learned from the labels."""
    docs = read(spark, folder, "documents")
    out = judge(docs.select("doc_id", "text"), fit(docs, read(spark, folder, "labels")))
    return out.select("doc_id", *[F.col(f"_q_{c}").alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")])
