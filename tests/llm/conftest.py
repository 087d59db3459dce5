import pytest
from pyspark.sql import functions as F

#: Long, empty, null and plain texts, ties and repeated rows, a null id and a null source.
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog and runs to the river of that old town", "a"),
    (2, "", "a"), (3, None, "b"), (4, LONG, "b"), (5, " \t\n ", None), (None, "no id at all here", "a"),
    (7, "same words again and again", "c"), (7, "same words again and again", "c"), (7, "another text of one id", "c"),
    (8, "naïve çà — 東京 emoji 😀 <|endoftext|> `x` \\<turn>", "é"), (9, "a", None),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Edge rows, with extra columns named like those that the operators add."""
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string, source string")
    clash = {"size": "x", "Score": "x", "n_words": "x", "spans": "x", "kept": "x", "row": "x", "shard": "x",
             "n_tokens": "x", "fingerprint": "x", "key": "x", "`odd.name": "x"}
    return rows.select("*", *[F.lit(v).alias(k) for k, v in clash.items()])


@pytest.fixture(scope="session")
def none(docs):
    return docs.filter(F.lit(False))
