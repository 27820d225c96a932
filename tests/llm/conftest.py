from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank, very long and repeated texts, repeated rows, ties."""
    long = " ".join(prose(1, 30_000))
    copy = " ".join(prose(2, 120))
    words = prose(2, 120)
    words[60] = "changed"
    texts = [None, "", " \n\t", "word", copy, copy, " ".join(words), long, "a" * 5000, "é😀 " * 40]
    rows = [(i, t, "en", "s1", len(t or "")) for i, t in enumerate(texts)]
    rows += [(20, copy, None, None, None), (20, copy, None, None, None)]
    rows += [(None, "no number " * 30, "de", "s2", 1)]
    return rows


@pytest.fixture
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def clash(odd):
    """Extra columns with the names that operators use for their own."""
    from pyspark.sql import functions as F

    names = "n_words spans probability topic tokens _text _row piece component_id a b seed rid kept"
    return odd.withColumns({name: F.lit(name) for name in names.split()})
