from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

WORDS = ["the", "erth", "onsh", "heed", "thing", "reat", "inor", "ndly", "tionst", "haou", "whis", "le", "eau", "über", "ción"]

#: documents with extra columns that are named like the operators' own ones
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.IntegerType()) for c in ("id", "n", "row", "key", "label", "score", "spans", "gram", "found", "row_key", "leaks", "copies", "text_key")],
    ]
)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "a", "en", "is"]) for _ in range(n))


def as_rows(docs):
    """(doc_id, text[, lang[, source]]) as full rows."""
    out = []
    for d in docs:
        d = (*d, *["en", "src1"][len(d) - 2 :])
        out.append((d[0], d[1], d[2], d[3], None if d[1] is None else len(d[1]), *range(13)))
    return out


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(docs):
        return spark.createDataFrame(as_rows(docs), DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def odd_docs():
    """Nulls, empty and blank texts, repeated rows and ids, one very long text."""
    return [
        (1, prose(1, 60)),
        (2, None),
        (3, ""),
        (4, " \t\n "),
        (5, prose(1, 60)),
        (5, prose(1, 60)),
        (6, prose(2, 400)),
        (6, prose(3, 400)),
        (None, prose(2, 400)),
        (None, None),
        (7, "x"),
        (8, prose(4, 60_000)),
        (9, "é" * 3000),
    ]
