"""Small tables with every odd case, and plain Python twins."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])

SYLLABLES = "an be co di er fu ga hi in jo ka li mo ne or pe qua ri sa to un ve wi xo yu ze th st".split()


def prose(rng: random.Random, n: int, line: int = 12) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    words[0] = words[0].capitalize()
    return "\n".join(" ".join(words[i:i + line]) + "." for i in range(0, n, line))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, repeated rows and equal texts."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    same = prose(rng, 80)
    return [
        (1, same, "en", "a", 10), (2, same, "en", "a", 10), (2, same, "en", "a", 10), (3, None, "en", None, None), (4, "", None, "a", 0),
        (None, prose(rng, 60), "en", "a", 1), (5, " \t\n ", "en", "a", 1), (6, long, "en", "b", len(long)), (7, "Élan ÀÉ ß 東京 😀 İ", "fr", "b", 3),
        (8, prose(rng, 90), "de", "b", 3), (9, "one", "en", "b", 3), (None, None, None, None, None),
    ]


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def clash(df):
    """Extra columns whose names operators also use."""
    from pyspark.sql import functions as F

    names = ["shard", "slot", "size", "fp", "name", "h", "at", "unit", "start", "end", "kept", "score", "piece", "length", "sequence_id", "offset",
             "component_id", "_id", "tokens", "item_id", "low", "n_words", "perplexity", "word", "c", "g", "n"]
    return df.withColumns({n: F.lit(7) for n in names if n not in df.columns})


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
