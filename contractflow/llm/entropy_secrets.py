"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings. Built-in Spark functions only.

The patterns (``BASE``) find assignments, access keys and long hexadecimal runs. Beyond them, every run of twenty or more
characters of the base-64 alphabets is a candidate. Its class follows from its characters, a window of ``WINDOW`` characters
slides over it, and the counts of the characters in the window, hence the Shannon entropy, are carried from one place to the next.
Windows at or above the threshold of the class are joined to a span. Candidates on the allow-list (identifiers of known form,
words joined by marks, alphabets in order, place holders), and those that touch a pattern's span, give none.

Spark has no function for all positions of a pattern. The text is split at the matches, and lengths of parts and matches add
up to the positions, in code points. Such running sums and maxima are made chunk by chunk (:func:`running`), so the work is about
linear in the matches. No pattern repeats a group that the engine could come back to, which would take a call a repeat.

Cases: a null text is empty and has no spans; rows are scanned alone; an empty table gives no rows. :func:`redact` keeps all
columns of its input; names that start with ``_s_`` are its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import query, read
from .decision_list import let

# Kinds in their order, and the pattern of each. Group 2 of ``assign`` has eight characters or more.
BASE = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]{12,}",
    "hex": "[0-9a-f]{32,}",
}
CANDIDATE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
WINDOW = 20
#: Class, what its strings look like, and the least entropy in bits of a window. The first class that fits counts.
CLASSES = (
    ("hex", "^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 3.0),
    ("mixed", "^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+$", 3.6),
    ("one_case", "^(?=.*[0-9].*[0-9])(?=.*[A-Za-z]).+$", 3.5),
    ("letters", "^(?=.*[a-z])(?=.*[A-Z])[^0-9]+$", 3.8),
    ("other", ".", 3.6),
)
#: Strings that are no secrets however they look.
ALLOWED = (
    "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    "^(?:[A-Z]{2,}+|[A-Za-z][a-z]*+|[0-9]++)(?:[-_/=+]++(?:[A-Z]{2,}+|[A-Za-z][a-z]*+|[0-9]++))*+[-_/=+]*+$",
    "(?i)abcdefgh|01234567|xxxxxx|example|placeholder",
)
SPAN = "array<struct<start:int,end:int>>"
CHUNK = 200


def running(items: Column, zero: Column, value: Callable[[Column], Column], join: Callable[[Column, Column], Column],
            kind: str = "int") -> Column:
    """For each item the ``join`` of the values of all items before it, ``zero`` for the first.

    An array that grows by one item is copied each time, so it is made for ``CHUNK`` items at a time, each chunk starting from the
    join of the chunks before it.
    """

    def before(values: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(values, state, lambda a, v: F.struct(
            join(a["at"], v).alias("at"), F.array_append(a["out"], a["at"]).alias("out")), lambda a: a["out"])

    def over(all_values: Column) -> Column:
        last = F.floor((F.size(all_values) - 1) / CHUNK).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_values, k * CHUNK + 1, CHUNK))
        return let(chunks, lambda c: let(before(F.transform(c, lambda x: F.aggregate(x, zero, join)), zero), lambda starts: F.flatten(
            F.zip_with(c, starts, before))))

    return let(F.transform(items, value), lambda v: F.when(F.size(v) > CHUNK, over(v)).otherwise(before(v, zero)))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches, left to right: ``start`` and ``end`` in code points, and ``value``, the text of ``group``."""
    parts = F.filter(F.arrays_zip(
        F.transform(F.split(text, pattern), lambda p: F.char_length(p)).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.char_length(m)).alias("size"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value")), lambda p: p["size"].isNotNull())

    def placed(p: Column) -> Column:
        at = running(p, F.lit(0), lambda x: x["gap"] + x["size"], lambda a, b: a + b)
        return F.zip_with(p, at, lambda x, before: F.struct(
            (before + x["gap"]).alias("start"), (before + x["gap"] + x["size"]).alias("end"), x["value"].alias("value")))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), let(parts, placed)).otherwise(none)


def untouched(found: Column, spans: Column) -> Column:
    """The matches that share no place with any span. One pass in order of starts finds the furthest end of the spans before a match, one
    pass back the nearest start of those after it."""
    far = 2 ** 31 - 1

    def items(array: Column, number: int, value: Callable[[Column], Column]) -> Column:
        return F.transform(array, lambda m: F.struct(
            m["start"].alias("start"), F.lit(number).alias("of"), m["end"].alias("end"), value(m).alias("value")))

    def chosen(both: Column) -> Column:
        ends = running(both, F.lit(0), lambda x: F.when(x["of"] == 0, x["end"]).otherwise(0), lambda a, b: F.greatest(a, b))
        starts = F.reverse(running(F.reverse(both), F.lit(far), lambda x: F.when(x["of"] == 0, x["start"]).otherwise(far), lambda a, b: F.least(a, b)))
        marked = F.zip_with(F.zip_with(both, ends, lambda x, e: F.struct(x.alias("x"), e.alias("e"))), starts, lambda y, s: F.struct(
            y["x"].alias("x"), ((y["x"]["of"] == 1) & (y["e"] <= y["x"]["start"]) & (s >= y["x"]["end"])).alias("free")))
        return F.transform(F.filter(marked, lambda y: y["free"]), lambda y: F.struct(
            y["x"]["start"].alias("start"), y["x"]["end"].alias("end"), y["x"]["value"].alias("value")))

    both = F.sort_array(F.concat(items(spans, 0, lambda m: F.lit("")), items(found, 1, lambda m: m["value"])))
    return F.when((F.size(spans) == 0) | (F.size(found) == 0), found).otherwise(let(both, chosen))


def entropy_span(text: Column, threshold: Column) -> Column:
    """First start and last end of the windows of ``text`` that reach the threshold; null if none does."""
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])
    w = lambda c: F.get(weight, c)

    def scan(chars: Column, alphabet: Column) -> Column:
        place = F.transform(chars, lambda c: F.array_position(alphabet, c).cast("int") - 1)

        def over(at: Column) -> Column:
            counts = F.transform(alphabet, lambda c: F.size(F.filter(F.slice(chars, 1, WINDOW), lambda x: x == c)))
            total = lambda n: F.aggregate(n, F.lit(0.0), lambda a, c: a + w(c))
            start = let(counts, lambda n: F.struct(n.alias("counts"), total(n).alias("sum"), F.lit(-1).alias("low"), F.lit(-1).alias("high")))

            def step(a: Column, i: Column) -> Column:
                """Look at the window at ``i``, then move it by one."""
                passes = F.lit(math.log2(WINDOW)) - a["sum"] / WINDOW >= threshold - 1e-9
                out, new = F.get(at, i), F.get(at, i + WINDOW)
                gone, come = F.get(a["counts"], out), F.get(a["counts"], new)
                still = new.isNull() | (out == new)
                return F.struct(
                    F.when(still, a["counts"]).otherwise(F.transform(
                        a["counts"], lambda c, k: c + F.when(k == new, 1).when(k == out, -1).otherwise(0))).alias("counts"),
                    F.when(still, a["sum"]).otherwise(a["sum"] + w(gone - 1) - w(gone) + w(come + 1) - w(come)).alias("sum"),
                    F.when(passes & (a["low"] < 0), i).otherwise(a["low"]).alias("low"),
                    F.when(passes, i + WINDOW).otherwise(a["high"]).alias("high"))

            done = lambda a: F.when(a["low"] >= 0, F.struct(a["low"].alias("start"), a["high"].alias("end")))
            return F.aggregate(F.sequence(F.lit(0), F.size(chars) - WINDOW), start, step, done)

        return let(place, over)

    return let(F.split(text, ""), lambda c: let(F.array_distinct(c), lambda a: scan(c, a)))


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_s_assign``, ``_s_access``, ``_s_hex`` and ``_s_entropy``, each an array of ``start`` and ``end``."""
    body = F.coalesce(F.col(text), F.lit(""))
    bare = lambda x: F.transform(x, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    docs = docs.withColumns({
        "_s_assign": bare(F.filter(matches(body, BASE["assign"], 2), lambda m: F.char_length(m["value"]) >= 8)),
        "_s_access": F.when(body.contains("AKIA"), bare(matches(body, BASE["access"]))).otherwise(F.array().cast(SPAN)),
        "_s_hex": bare(matches(body, BASE["hex"])),
        "_s_found": matches(body, CANDIDATE),
    })
    base = F.concat("_s_assign", "_s_access", "_s_hex")

    def threshold(value: Column) -> Column:
        return F.coalesce(*[F.when(value.rlike(looks), F.lit(least)) for _, looks, least in CLASSES])

    allowed = lambda v: v.rlike("|".join(f"({a})" for a in ALLOWED))
    chosen = untouched(F.filter("_s_found", lambda m: ~allowed(m["value"])), base)
    hot = F.transform(chosen, lambda m: let(entropy_span(m["value"], threshold(m["value"])), lambda s: F.when(
        s.isNotNull(), F.struct((m["start"] + s["start"]).alias("start"), (m["start"] + s["end"]).alias("end")))))
    return docs.withColumn("_s_entropy", F.filter(hot, lambda s: s.isNotNull())).drop("_s_found")


KINDS = [*BASE, "entropy"]


def listed(kinds: list[str]) -> Column:
    """``kind:start:end`` of all spans of the kinds, by start, then kind, joined by commas."""
    spans = F.sort_array(F.concat(*[
        F.transform(f"_s_{k}", (lambda n: lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("kind"), s["end"].alias("end")))(n))
        for n, k in enumerate(kinds)]))
    name = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each stretch of text that spans cover replaced by ``mark``; the other columns stay.

    ``length``, if there is such a column, gets the new number of code points where a text was changed.
    """
    def cut(spans: Column, chars: Column) -> Column:
        """Cut between spans in order; one that begins before the furthest end so far adds no mark of its own."""
        ends = running(spans, F.lit(0), lambda s: s["end"], lambda a, b: F.greatest(a, b))
        kept = F.filter(F.zip_with(spans, ends, lambda s, e: F.struct(s["start"].alias("to"), e.alias("of"))), lambda x: x["to"] >= x["of"])
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        all_parts = F.concat(kept, F.array(F.struct(F.size(chars).alias("to"), last.alias("of"))))
        return F.array_join(F.transform(all_parts, lambda x: F.array_join(F.slice(chars, x["of"] + 1, x["to"] - x["of"]), "")), mark)

    spans = F.sort_array(F.concat(*[f"_s_{k}" for k in KINDS]))
    cut_text = let(spans, lambda s: let(F.split(F.col(text), ""), lambda c: cut(s, c)))
    new = with_spans(docs, text).withColumn("_s_n", sum(F.size(f"_s_{k}") for k in KINDS)).withColumn(
        "_s_text", F.when(F.col("_s_n") > 0, cut_text).otherwise(F.col(text)))
    out = {text: F.col("_s_text")}
    if length and length in docs.columns:
        out[length] = F.when(F.col("_s_n") > 0, F.char_length("_s_text").cast(docs.schema[length].dataType)).otherwise(F.col(length))
    return new.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in docs.columns])


@query("op7_entropy_secrets")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document: counts and digest of the patterns' spans, and all spans."""
    found = with_spans(read(spark, folder, "documents").select("doc_id", "text")).drop("text")
    return found.select(
        "doc_id", *[F.size(f"_s_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(list(BASE)), 256).alias("base_sha256"), listed(KINDS).alias("spans"))
