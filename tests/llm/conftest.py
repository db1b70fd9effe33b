import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens long, rid long, token string, score double, root long, _gone int, _mark int, mark int, th long, _id long, label int, family long, place long, row string"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with those the operators use inside."""

    def frame(rows):
        return spark.createDataFrame([(i, t, None, None, None if t is None else len(t), 1, 2, "x", 0.5, 3, 1, 2, 3, 4, 5, 1, 7, 8, "r") for i, t in rows], DOCS)

    return frame


@pytest.fixture(scope="session")
def prose():
    """Words of a seeded invented language."""
    syllables = ["the", "er", "ing", "on", "an", "re", "th", "st", "en", "é", "ü", "tion"]

    def text(seed, n=80):
        r = random.Random(seed)
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))

    return text
