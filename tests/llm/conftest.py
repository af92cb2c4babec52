import random

import pytest

LETTERS = "the of and er on in re th ng st ea ti".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, white, one-word, repeated, very long and ordinary texts; null ids and sources."""
    rng = random.Random(5)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    long = prose(rng, 30_000)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, "one", "de", None), (5, base, "en", "a"),
        (6, base, "en", "b"), (6, base, "en", "b"), (7, " ".join(near), "en", "a"), (None, prose(rng, 50), "en", "b"), (None, None, None, None),
        (8, long, "en", "a"), (9, "Ein Wort und noch ein Wort: straße größe über", "de", "b"), (10, "!!! 123 ???", None, "a"),
        (11, "a b c d " * 40, "en", "c"), (12, "x\nx\nx\n\nx\n", "en", "c"), (13, prose(rng, 25), None, None),
    ]
    return [(*r, i, i * 2) for i, r in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string, n_words int, n long").repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_words int, n long")
