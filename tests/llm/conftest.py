import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
BASE = " ".join(f"w{i}" for i in range(60))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away."),
    (2, "The quick brown fox jumps over the lazy dog and runs away."),
    (3, None),
    (4, ""),
    (5, "  \n\t "),
    (6, "two words"),
    (7, LONG),
    (8, BASE),
    (9, BASE.replace("w30 ", "changed ")),
    (10, " ".join(f"w{i}" for i in range(4, 64))),
    (None, BASE),
    (None, None),
    (6, "two words"),
    (11, "Größe naïve 日本語 𝔘 !!! 12"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and extra columns with names that operators use themselves."""
    rows = [(i, t, "en", None, 0, {"a": "b"}) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, node string, token string, n int, row map<string,string>")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
