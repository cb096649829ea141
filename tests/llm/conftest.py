import random

import pytest

ODD = [None, "", " ", "\n\n", "a", "word " * 3000, "Tab\tand\x01mark", "x" * 5000, "é ü ñ  double  space ", "same text here for all five words", "same text here for all five words"]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in both columns, empty, long and repeated texts, and extra columns with clashing names."""
    rows = [(i, t, "a", 1, "b") for i, t in enumerate(ODD)] + [(None, "no id at all", None, None, None), (3, "an id again", "q", 2, "z")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string, piece int, spans string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]

    def make(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(words) for _ in range(n))

    return make
