from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, names that clash."""
    base = " ".join(f"w{i}" for i in range(120))
    rows = [
        (1, base, "x", 1, "c"),
        (2, base, "x", 2, None),
        (2, base, "x", 2, None),
        (3, None, None, None, "c"),
        (4, "", "y", 0, "c"),
        (5, " \t\n", "y", 3, "c"),
        (None, base + " tail", None, None, None),
        (None, None, None, None, None),
        (6, " ".join(f"v{i % 977}" for i in range(60_000)), "x", 9, "c"),
        (7, base.upper() + " END", "x", 9, "c"),
        (8, "one two", "x", 9, "c"),
        (9, "One TWO", "x", 9, "c"),
        (10, "été Ünïcode 梦想 " + base, "x", 9, "c"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, n long, class string")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
