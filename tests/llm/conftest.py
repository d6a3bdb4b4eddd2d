import random

import pytest

SCHEMA = "doc_id long, text string, rep string, body string, h long, k0 int, digest string, seed long, rows long, n_tokens string, source string, lang string"


def prose(rng, n, words=None):
    words = words or [f"{a}{b}" for a in ("ar", "be", "co", "du", "el", "fi", "go") for b in ("ma", "ne", "ri", "so", "tu", "va", "xi", "zo")]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank, very long and repeated texts."""
    rng = random.Random(5)
    long = prose(rng, 120_000)
    texts = [(1, "plain words here"), (2, None), (3, ""), (4, " \n\t "), (5, long), (6, "plain words here"), (6, "plain words here"), (None, "no id at all"), (None, None), (7, "é" * 3), (8, "x" * 50_000), (9, "\x00\\<[|>")]
    return [(i, t, None, "b", None, 1, None, 2, None, None, None, None) for i, t in texts]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
