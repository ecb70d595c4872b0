import random

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, lang, source]) tuples."""

    def build(rows, extra=""):
        full = [(*r, *("en", "s")[len(r) - 2 :])[:4] if len(r) < 4 else r for r in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string" + extra)

    return build


@pytest.fixture
def rng():
    return random.Random(7)
