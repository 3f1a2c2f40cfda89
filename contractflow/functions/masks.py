"""Irreversible masks for personal data. NULL always stays NULL."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that replaces a redacted value.
REDACTED = "***REDACTED***"


def mask_hash(c: Column, salt: str = "") -> Column:
    """SHA-256 as hex text, over the salt followed by the value."""
    text = c.cast("string")
    return F.sha2(F.concat(F.lit(salt), text) if salt else text, 256)


def mask_redact(c: Column) -> Column:
    return F.when(c.isNotNull(), F.lit(REDACTED))


def mask_nullify(c: Column, data_type="string") -> Column:
    return F.lit(None).cast(data_type)
