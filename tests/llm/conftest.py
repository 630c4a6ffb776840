from __future__ import annotations

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        # Names that operators use for their own columns.
        *(T.StructField(name, T.StringType()) for name in ("key", "spans", "score", "node", "label", "n", "shard", "hits")),
    ]
)


def odd_rows() -> list[tuple]:
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    passage = " ".join(f"{w}{i}" for i in range(4) for w in words)
    long_text = " ".join(f"w{i % 9973}" for i in range(60_000))
    texts = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, passage), (6, passage), (7, "Before it " + passage + " and after"),
        (8, long_text), (9, long_text + " end"), (10, "a a a a " * 40), (11, "\x1c odd \x85 gaps  in　it \r\n here"), (12, passage.upper()),
        (13, "<|endoftext|> and 's don't  é日本 😀"), (5, passage), (14, "same id"), (14, "other text"), (None, passage), (None, None),
        (15, "Der Hund und die Katze"), (16, "the dog and the cat"),
    ]
    return [(i, t, "de" if i == 15 else "en" if i and i % 2 == 0 else None, *["x"] * 8) for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty and very long texts, repeated ids and rows, columns with clashing names."""
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def odd_texts():
    return [(r[0], r[1]) for r in odd_rows()]
