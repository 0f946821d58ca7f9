import random

import pytest
from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(40_000))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank and very long texts, repeated rows, a null id, and columns named like those of operators."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("score", T.StringType()),
            T.StructField("Kept", T.StringType()),
            T.StructField("n_words", T.StringType()),
            T.StructField("ids", T.StringType()),
            T.StructField("a.b `c`", T.StringType()),
        ]
    )
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, LONG), (5, "same text in two rows\nAll rights reserved."),
        (5, "same text in two rows\nAll rights reserved."), (6, "SAME text in two rows\nall rights RESERVED."), (None, "no id here"),
        (None, "same text in two rows\nAll rights reserved."), (7, "12345 67890 !!! ###"), (8, "<|endoftext|> é 日本語 😀 x y"), (9, "\n\n\n"),
    ]
    return spark.createDataFrame([(i, t, None, "s", "k", "n", "i", "x") for i, t in texts], schema)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def vocabulary():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path


@pytest.fixture
def prose():
    """Made-up prose of a vocabulary of 300 words."""

    def make(seed, words):
        r = random.Random(seed)
        return " ".join(f"w{r.randrange(300)}" + r.choice(["", "", "", ".", ","]) for _ in range(words))

    return make
