import random

import pytest
from text_support import prose

SCHEMA = "doc_id long, text string, lang string, node long, key string, digest string, root long, rank int, n long, found string, count long"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, short and long texts, repeats, ties, non-Latin letters, control characters."""
    rng = random.Random(3)
    long = prose(rng, 12_000)
    base = prose(rng, 120)
    words = base.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    texts = [
        (1, None), (2, ""), (3, "a"), (3, "a"), (4, " \t\n "), (5, base), (6, base), (7, near), (7, base), (None, near),
        (None, None), (8, long), (9, long + " end"), (10, "Ünï cödé 漢字 😀 ok\x00\x1c é"), (11, "one two three four five"),
        (12, "one two three four five"), (-13, "x" * 5000), (14, "A b\nA b\n\nA b"), (15, base.upper()),
    ]
    return [(i, t, "en", 7, "k", "d", 1, 2, 3, "f", 4) for i, t in texts]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
