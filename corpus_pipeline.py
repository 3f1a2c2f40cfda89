"""A training corpus in five stages: quality rules, near-duplicates, decontamination, secrets, packing.

A stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's docs. All but the
last return the columns of ``documents``. Each works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contractflow.llm import decision_list, decontaminate, entropy_secrets, packing, simhash
from contractflow.llm.base import read, settings
from contractflow.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or meet a learned rule go."""
    settings(spark)
    return decision_list.reject(docs, decision_list.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group within two bits of each other, the row of the lowest id stays; null ids come last."""
    settings(spark)
    return simhash.keep_first_row(docs, length=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    settings(spark)
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; no document goes."""
    settings(spark)
    return entropy_secrets.redact(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens, a row a piece with its token ids."""
    settings(spark)
    return packing.pack(docs, limit=2048)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("best_fit_packing", best_fit),
]

#: Learned rules, fingerprints and tokenizers can't be expressed in SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = settings(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
