import random

import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) rows, with extra columns whose names clash with inner ones."""
    def make(rows, **extra):
        schema = "doc_id long, text string, lang string, source string, n_chars long, row int, n int, token string, line string, h1 int, hit string"
        return spark.createDataFrame([(i, t, None, None, None, 1, 2, "x", "y", 3, "z") for i, t in rows], schema)

    return make


@pytest.fixture
def words():
    """Seeded random words."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdefghijk") for _ in range(r.randint(2, 7))) for _ in range(400)]
    return lambda n: [r.choice(vocabulary) for _ in range(n)]
