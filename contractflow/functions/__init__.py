"""Column helpers: masks, keys, exact sums, calendar parts, text classification."""

from .calendar import calendar_columns, date_key, older_than, parse_period
from .keys import packed, surrogate_key, unpacked
from .masks import REDACTED, mask_hash, mask_nullify, mask_redact
from .numeric import ratio, total
from .text import OrderedRules, TextRule, classify, joined_lower_text, score_lookup

__all__ = [
    "REDACTED",
    "OrderedRules",
    "TextRule",
    "calendar_columns",
    "classify",
    "date_key",
    "joined_lower_text",
    "mask_hash",
    "mask_nullify",
    "mask_redact",
    "older_than",
    "packed",
    "parse_period",
    "ratio",
    "score_lookup",
    "surrogate_key",
    "total",
    "unpacked",
]
