"""Edge rows that every operator must take: nulls in any column, empty and very long
texts, ties, repeated rows and extra columns with clashing names."""

from __future__ import annotations

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(30_000))
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in ("row", "kept", "stats", "digest", "r", "fp", "slot", "place", "id", "h_id",
                                                 "u", "v", "loser", "n", "order0", "held_out", "size", "word", "grp")]])
EXTRA = tuple(f"x{i}" for i in range(len(SCHEMA) - 4))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "a"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "a"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "en", "a"),  # a repeated row
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, LONG, None, None),
    (None, "no id here", "de", "a"),
    (None, None, None, None),
    (7, "ÄÖÜ straße 東京\n\n\x0b \ttabs\r\n", "de", "b"),
    (8, "   ", "fr", "b"),
]


def edge_docs(spark):
    return spark.createDataFrame([r + EXTRA for r in ROWS], SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
