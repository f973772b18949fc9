from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        # names that operators add or use inside
        T.StructField("size", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("_unit", T.LongType()),
        T.StructField("_row", T.StringType()),
        T.StructField("n_words", T.StringType()),
    ]
)


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    bits = ["the", "of", "and", "ra", "lo", "mi", "ten", "su", "ka", "ver", "ion", "el"]
    return " ".join("".join(draw.choice(bits) for _ in range(draw.randint(1, 3))) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls, empty and long texts, ties and repeated rows."""
    texts = [None, "", " \t\n\x0b", "one", prose(1, 40), prose(1, 40), prose(2, 30_000), "Ä ß x", "a b c d", "A B c D"]
    rows = [(i, text, "ab"[i % 2]) for i, text in enumerate(texts)]
    rows += [(None, prose(3, 20), None), (None, None, None), (4, prose(1, 40), "a"), (4, prose(1, 40), "a")]
    return [(*row, "s", "t", 0.5, 7, "r", "w") for row in rows]


@pytest.fixture(scope="session")
def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), DOCUMENTS)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)
