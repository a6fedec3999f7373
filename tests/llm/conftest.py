import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, copy int, row int, kept long, range int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text), with columns whose names the operators use themselves."""

    def build(items):
        return spark.createDataFrame([(i, t, None, None, None, "x", 1, None, 7, 3) for i, t in items], SCHEMA)

    return build


@pytest.fixture(scope="session")
def awkward(docs_of):
    """Nulls, empty and very long texts, ties, repeated rows."""
    words = [f"w{random.Random(i).randrange(3000)}" for i in range(60_000)]
    return docs_of(
        [
            (None, None),
            (None, "some text of a document without an id"),
            (1, ""),
            (2, " \n\t "),
            (3, "one"),
            (4, "The same row, twice. " * 30),
            (4, "The same row, twice. " * 30),
            (5, "The same row, twice. " * 30),
            (5, "The same id, another text."),
            (6, " ".join(words)),
            (7, "ßÄé 中文 😀 \u2581 \x00 ... " * 40),
            (8, "a" * 5000),
        ]
    )
