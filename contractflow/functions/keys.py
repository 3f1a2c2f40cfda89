"""Surrogate keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(keys: list[Column], effective_from: Column) -> Column:
    """SHA-256 over a JSON list of the business key and the start of the version.

    JSON keeps values apart (no separator can be forged) and tells NULL from ''.
    """
    start = F.date_format(effective_from, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.sha2(F.to_json(F.array(*[k.cast("string") for k in keys], start)), 256)


def packed(text: Column) -> Column:
    """A string as a struct of half its size if it is lower-case hex, such as a surrogate key; any other string as it is."""
    digest = F.unhex(text)
    same = F.lower(F.hex(digest)) == text
    return F.struct(F.when(same, digest).alias("digest"), F.when(same, F.lit(None).cast("string")).otherwise(text).alias("text"))


def unpacked(value: Column) -> Column:
    """The string of :func:`packed`."""
    return F.coalesce(F.lower(F.hex(value["digest"])), value["text"])
