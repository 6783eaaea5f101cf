from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: What every operator must take: nulls, empty and blank texts, ties, repeated rows, a long text.
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def long_text(words: int, seed: int = 1) -> str:
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 400)) for _ in range(words))


HARD = [
    (1, "alpha beta  gamma\n", "en", "a", 1),
    (1, "alpha beta  gamma\n", "en", "a", 1),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n", "de", "b", 3),
    (None, "alpha beta gamma", None, "b", 5),
    (5, "alphabetagamma", "en", None, 9),
    (6, long_text(60_000), "en", "c", 0),
    (7, "ÄÖÜ ß 日本 \U0001f600 é", "de", "c", 0),
    (8, "12345 ... 678", "en", "c", 0),
    (-9, "alpha beta gamma delta", "en", "a", 0),
]


@pytest.fixture(scope="session")
def hard(spark):
    """Hard rows with extra columns whose names clash with those that operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(HARD, DOCUMENT).repartition(3)
    clash = ("size key bucket rep norm rank id word at copies target mark row of part").split()
    return df.select("*", *[F.lit("x").alias(c) for c in clash])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
