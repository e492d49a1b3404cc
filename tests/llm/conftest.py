from __future__ import annotations

import random

import pytest
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


@pytest.fixture(scope="session")
def texts():
    """Texts of every awkward kind, with near copies, ties and repeated rows among them."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    made = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 120))) for _ in range(40)]
    near = []
    for text in made[:10]:
        parts = text.split()
        parts[len(parts) // 2] = "changed"
        near.append(" ".join(parts))
    awkward = [
        None, "", " ", "\n\t", "one", "two words", "a b c d", "A B C D", "é ü ß 漢字 emoji 😀", "x" * 5000, "y " * 6000,
        "  runs   of \n\n white space   here ", "it's we'll 123 4.5,6!?", "a" + "́" + " combining", "\x1c odd \x85 marks",
    ]
    return [*made, *near, *made[:5], *awkward]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, x, "en", None if i % 7 == 0 else f"s{i % 3}", len(x or "")) for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
