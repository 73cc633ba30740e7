from __future__ import annotations

import random

import pytest

WORDS = "amber birch cedar delta ember fjord grove heath inlet jetty knoll ledge marsh north ocean".split()


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long = prose(30_000, 1)
    return [
        (1, prose(80, 2), "en", "a", 10),
        (1, prose(80, 2), "en", "a", 10),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t ", "en", None, 4),
        (None, prose(60, 3), None, "b", None),
        (None, None, None, None, None),
        (5, long, "en", "b", len(long)),
        (6, prose(80, 2), "en", "c", 10),
        (7, "One.", "en", "c", 4),
        (8, "x" * 200_000, "en", "c", 200_000),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    """Extra columns named as the operators' own."""
    from pyspark.sql import functions as F

    names = ("size", "taken", "key", "n_words", "kept", "class_id", "words", "score", "label", "spans", "piece")
    return odd_docs.withColumns({n: F.lit("x") for n in names})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
