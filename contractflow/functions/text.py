"""Rule-based text classification as one CASE expression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TextRule:
    """``label`` applies when any of ``any_of`` occurs; an entry that is a tuple needs all its parts."""

    label: str
    any_of: tuple[str | tuple[str, ...], ...]

    def matches(self, text: Column) -> Column:
        hits = []
        for entry in self.any_of:
            parts = (entry,) if isinstance(entry, str) else entry
            hits.append(reduce(Column.__and__, [F.contains(text, F.lit(p)) for p in parts]))
        return reduce(Column.__or__, hits)


@dataclass(frozen=True)
class OrderedRules:
    rules: tuple[TextRule, ...]
    default: str


def joined_lower_text(*parts: Column) -> Column:
    """Lower-cased parts joined with a blank; NULL parts are skipped."""
    return F.lower(F.concat_ws(" ", *parts))


def classify(text: Column, table: OrderedRules) -> Column:
    """Label of the first rule that matches, else the default."""
    chain = reduce(lambda acc, r: acc.when(r.matches(text), F.lit(r.label)), table.rules[1:],
                   F.when(table.rules[0].matches(text), F.lit(table.rules[0].label)))
    return chain.otherwise(F.lit(table.default))


def score_lookup(c: Column, scores: Mapping[str, Any] | Sequence[tuple[str, Any]], default: Any) -> Column:
    """Score of a label from a small fixed table."""
    pairs = list(dict(scores).items())
    chain = reduce(lambda acc, p: acc.when(c == p[0], F.lit(p[1])), pairs[1:],
                   F.when(c == pairs[0][0], F.lit(pairs[0][1])))
    return chain.otherwise(F.lit(default)).cast("float")
