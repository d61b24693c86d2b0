from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row long, id long, doc long, fp long, kind int, start long, token string, word string, u long, v long"
)
LONG = 120_000


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "src0", None if text is None else len(text), 7, 7, 7, 7, 7, 7, "x", "y", 1, 2)


@pytest.fixture(scope="session")
def make(spark):
    """Documents with further columns, whose names operators use within."""

    def build(rows):
        return spark.createDataFrame([row(*r) for r in rows], SCHEMA)

    return build


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words, the same every time."""

    def build(n, words=60, seed=1):
        rng = random.Random(seed)
        parts = "the of and re tion ing er th an ha é ß lo mi ka".split()
        return [" ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words)) for _ in range(n)]

    return build


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Null, empty and very long texts, spaces only, repeated rows and a null id."""
    some = prose(4, seed=9)
    long = " ".join(prose(1, words=LONG // 6, seed=10))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, some[0]), (4, some[0]), (5, some[1]), (None, some[2]), (6, long), (7, some[3]), (8, some[1]),
    ]
