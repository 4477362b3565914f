from __future__ import annotations

import pytest
from pyspark.sql import types as T

LONG = "long words and more " * 20_000

#: Nulls, empty texts, a very long text, ties, and repeated rows.
HOSTILE = [
    (0, None, "en", None),
    (1, "", None, "b"),
    (2, " \t\n ", "en", "b"),
    (3, "one", "en", "a"),
    (4, "one two", "de", "a"),
    (5, LONG, "en", "a"),
    (6, "The same text, twice over; the same text.", "en", None),
    (7, "The same text, twice over; the same text.", "fr", "a"),
    (7, "The same text, twice over; the same text.", "fr", "a"),
    (8, "naïve 日本語 😀 x▁y", "ja", ""),
    (9, "", "en", "b"),
    (None, "no id here", "en", "a"),
    (None, None, None, None),
]

#: Documents, with further columns whose names operators use inside.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        *[T.StructField(c, T.IntegerType()) for c in ("n", "size", "start", "block", "score", "node", "ids", "shard")],
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    def make(rows):
        return spark.createDataFrame([(*r, *range(8)) for r in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def hostile(documents):
    return documents(HOSTILE)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
