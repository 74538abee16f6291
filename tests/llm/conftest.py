import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from texts, with columns whose names might clash and nulls in every column."""

    def make(texts, langs=None, sources=None):
        langs, sources = langs or {}, sources or {}
        rows = [(i, t, langs.get(i), sources.get(i), None, 7, "x") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA + ", n_words long, hits string")

    return make


@pytest.fixture
def prose():
    """Seeded texts of invented words."""

    def make(n, words=60, seed=1, vocabulary=None):
        rnd = random.Random(seed)
        vocabulary = vocabulary or ["".join(rnd.choice("abcdefghijklmnoprstuvw") for _ in range(rnd.randint(2, 8))) for _ in range(800)]
        return [" ".join(rnd.choice(vocabulary) for _ in range(words)) for _ in range(n)]

    return make
