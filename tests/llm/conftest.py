import random

import pytest

#: Nulls, empties, ties, repeats, odd characters and one long text.
TEXTS = [
    None, "", " ", "a", "the cat sat on the mat and the cat ran away from the mat",
    "The cat sat on the mat and the cat ran away from the mat", "x" * 5000, " \n\t  \u3000 two  spaces \x1c end ",
    "Crème brûlée 漢字 🙂🙂 ² ½ Ⅷ don't we'll 12345 ...!!!", "a b", "a b", "word " * 3000,
]


@pytest.fixture(scope="session")
def messy(spark):
    """doc_id, text and columns whose names clash with what operators return."""
    rows = [(i, t, "other", 0.5, b"", 1) for i, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], "again", 0.1, b"", 2), (None, "no id at all but a text of some words", "x", 0.0, b"", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, TEXT string, score double, token_ids binary, `class` long")


@pytest.fixture(scope="session")
def no_docs(messy):
    return messy.limit(0)


@pytest.fixture(scope="session")
def words():
    """A generator of invented words."""
    def make(seed: int, n: int) -> list[str]:
        rng = random.Random(seed)
        return ["".join(rng.choice(["ta", "ri", "mo", "ne", "lu", "ska", "ve"]) for _ in range(rng.randint(2, 4))) for _ in range(n)]
    return make
