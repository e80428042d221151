from __future__ import annotations

import random

import pytest
from pyspark import cloudpickle
from pyspark.sql import types as T

import sluiceworks

cloudpickle.register_pickle_by_value(sluiceworks)

SF = "/root/testdata/sf0.001"
# columns of a caller that have names that the operators use themselves
CLASHES = ("score", "kept", "print", "n_words", "n_removed", "component", "key", "_row", "words", "row", "_of", "_starts", "_spans", "spans", "starts", "text_")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("text", "lang", "source", *CLASHES)]
)


def words(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(n))


LONG = words(20_000, 1)
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (4, "one"),
    (5, LONG),
    (6, LONG),
    (7, words(60, 2)),
    (7, words(60, 3)),
    (8, words(60, 2) + " end"),
    (9, "x " + words(40, 4) + "\n" + words(40, 4) + "  y "),
    (None, words(30, 5)),
    (None, None),
    (10, "Ünïcode 文字 été🎉 mail a.b@c.de, ip 10.0.0.1 card 4111 1111 1111 1111 tel +49 (30) 123-45 67"),
    (11, "The MIT License and apache license; CC-BY. gnu general public license mit license"),
    (2**62, words(20, 6)),
]


def frame(spark, rows=TEXTS):
    """Rows of (doc_id, text), with other columns that clash."""
    filled = [(d, t, None if i % 3 else "en", None if i % 2 else "s", *["x"] * len(CLASHES)) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(filled, SCHEMA)


@pytest.fixture(scope="session")
def edge(spark):
    return frame(spark)


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the smallest table."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}
