import random

import pytest
from pyspark.sql import types as T

SF = "/root/testdata"

EXTRA = ["_text", "_id", "id", "size", "ids", "key", "score", "kept", "n", "start", "sig", "mark", "n_tokens", "list", "_row", "times"]

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    *(T.StructField(c, T.StringType()) for c in EXTRA)])


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["than", "on", "er", "the", "wh", "ing", "é", "sh", "ou"]) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text, source) rows as a table with columns whose names operators use inside."""
    def make(rows, parts=3):
        return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], DOCS).repartition(parts)
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = prose(1, 60_000)
    return [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one two", "b"), (5, "ONE two", "b"), (5, "ONE two", "b"),
        (None, prose(2, 40), "a"), (None, prose(2, 40), "a"), (7, prose(2, 40), None), (8, long, "c"), (9, long.upper(), "c"),
        (10, "été\x1c “q” <|endoftext|> it's </s>", "é"), (10, "another text of the same id", "é"), (11, prose(3, 300), "b")]
