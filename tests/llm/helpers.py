"""Small tables for the corpus operators, and plain versions of what they compute."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Nulls, empties, repeated rows, copies, one long text, odd characters."""
    base = words(1, 150)
    rows = [
        (1, base, "en", "a", 5),
        (1, base, "en", "a", 5),
        (2, base, None, "a", 5),
        (3, base.replace(base.split()[70], "other", 1), "en", "b", 5),
        (4, None, "en", None, None),
        (5, "", "en", "b", 0),
        (None, "only text", None, None, None),
        (7, " \n\t ", "en", "c", 4),
        (8, "short one", "en", "c", 9),
        (9, words(2, 6000), "en", "b", 1),
        (10, words(3, 120) + " " + base[:500] + " " + words(4, 50), "de", "a", 1),
        (11, "naïve ß É 中文字 𝒳 \x1c á <|endoftext|>x it's", "xx", "a", 1),
        (12, "aaaa" * 400, "xx", "a", 1),
        (-13, words(5, 90), "xx", "a", 1),
    ]
    return rows


def docs(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, DOCS)


def clashing(spark, rows=None):
    """The same with columns named like those the operators add."""
    from pyspark.sql import functions as F

    names = "node copies copy mix_key mix_rate shard slot vslot secret_spans toxicity offending sequence_id offset part key tile a b"
    return docs(spark, rows).select("*", *[F.lit("x").alias(n) for n in names.split()])


def empty(spark):
    return spark.createDataFrame([], DOCS)
