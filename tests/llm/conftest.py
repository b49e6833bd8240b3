from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs."""
    return lambda rows: spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], DOCS)


@pytest.fixture
def prose():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(800)]
    return lambda n, seed=0: [random.Random(seed * 7919 + i).choice(vocabulary) for i in range(n)]


#: NULL, empty, blank, short and repeated texts; ids that are NULL or repeat.
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, "two words"), (5, "two words"), (None, "no id here at all"), (None, None), (6, "É" * 5), (7, "x" * 300_000)]


@pytest.fixture
def odd():
    return list(ODD)
