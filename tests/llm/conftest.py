import random
import string

import pytest

WORDS = ["The", "river", "runs", "über", "stone", "naïve", "and", "of", "quick", "Brown", "señor", "42", "x-ray"]


@pytest.fixture
def rng():
    return random.Random(7)


@pytest.fixture
def prose(rng):
    """A text of n words."""

    def make(n):
        return " ".join(rng.choice(WORDS) + "".join(rng.choices(string.ascii_lowercase, k=rng.randrange(4))) for _ in range(n))

    return make


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text[, lang]) rows, with columns that clash with the operators' own."""

    def make(rows):
        kind = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string"
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", None, 0.5, None) for r in rows]
        return spark.createDataFrame(full, kind)

    return make
