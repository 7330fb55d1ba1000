import random

import pytest

LONG = 60_000


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    syllables = "the on ing er tion an re st ha le de ou é ß ñ".split()
    return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty and very long texts, repeated rows, ties and columns with names that operators use themselves."""
    long = prose(1, LONG)
    rows = [
        (1, "some words here", "en", "a", 15),
        (1, "some words here", "en", "a", 15),
        (2, "", None, "a", 0),
        (3, None, "en", None, None),
        (None, "a row without an id", "en", "b", 19),
        (None, None, None, None, None),
        (4, long, "fr", "b", len(long)),
        (5, "x" * 3000, "en", "", 3000),
        (6, "\n\n \t\n漢字かな \U0001f600 é\r\n", "xx", "a", 1),
        (7, prose(2, 300), "en", "a", 1),
        (8, prose(2, 300), "en", "a", 1),
        (9, prose(2, 300) + " more", "en", "a", 1),
    ]
    rows = [(*r, i, f"k{i}", float(i), None) for i, r in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node long, key string, score double, copy int").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
