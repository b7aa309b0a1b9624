from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from snapline.llm.registry import ready


@pytest.fixture(scope="session")
def llm(spark):
    return ready(spark)


def words(n: int, seed: int, alphabet: str = "abcdefgh") -> str:
    drawn = random.Random(seed)
    return " ".join("".join(drawn.choice(alphabet) for _ in range(drawn.randrange(2, 9))) for _ in range(n))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

LONG = "x" * 1_200_000 + " " + words(2000, 1) + " tail"


@pytest.fixture(scope="session")
def messy(llm):
    """Nulls in every column, empty and very long texts, repeated rows, ties, and columns whose
    names operators use themselves."""
    texts = [
        (1, words(120, 3), "en", "a"), (2, words(120, 3), "en", "a"), (2, words(120, 3), "en", "a"), (2, words(40, 5), None, "b"),
        (3, "", "en", "a"), (4, None, "de", None), (None, words(80, 8), "en", "a"), (None, None, None, None), (5, LONG, "en", "a"),
        (6, "a\x00b \t\n  é中😀 " + words(30, 9), "fr", "a"), (7, " ", "fr", "a"), (8, "!!! 123 ???", "de", "a"),
    ]
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in texts]
    df = llm.createDataFrame(rows, SCHEMA)
    clashing = ("score", "fp", "key", "id", "begin", "spans", "segment", "place", "d1", "root", "held_out", "predicted", "least", "digest", "__digest", "__id", "__words", "evidence", "words", "row", "mark")
    return df.withColumns({name: F.lit(7) for name in clashing})


@pytest.fixture(scope="session")
def nothing(llm):
    return llm.createDataFrame([], SCHEMA)
