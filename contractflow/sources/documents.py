"""Field extraction from whole text documents, one regular expression per field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import Contract


def read_documents(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """Each file as one row: ``file_path`` and its whole ``text``."""
    return (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text"))
    )


def extracted(text: Column, pattern: str) -> Column:
    """First group of the first match, trimmed; NULL without a match."""
    return F.nullif(F.trim(F.regexp_extract(text, pattern, 1)), F.lit(""))


def extract_fields(df: DataFrame, contract: Contract, text: str = "text") -> DataFrame:
    """Declared columns: those with a pattern from the text, the others by name."""
    return df.select(*[
        (extracted(F.col(text), f.extract) if f.extract else F.col(f.name)).alias(f.name) for f in contract.fields
    ])
