import random

import pytest

WORDS = "the of and thanea ering onthe über élan señor idiot scum license x1 | # don't".split()


@pytest.fixture(scope="session")
def make_text():
    """Reproducible prose of n words, some lines long."""

    def make(seed: int, n: int) -> str:
        rng = random.Random(seed)
        made = []
        for _ in range(n):
            word = rng.choice(WORDS) if rng.random() < 0.5 else "".join(rng.choices("aeiounrstl", k=5))
            made.append(word + rng.choice([" ", " ", " ", "\n", "\t", ". "]))
        return "".join(made)

    return make


@pytest.fixture(scope="session")
def odd_documents(spark, make_text):
    """Nulls in any column, empty and long texts, repeated rows, and columns whose names clash with
    those that operators use inside."""
    long = make_text(1, 30_000)
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, "   \n\t ", "en", "a", 6),
        (4, "one", "en", "a", 3),
        (5, long, "en", "b", len(long)),
        (None, "no id at all here", "en", "b", None),
        (6, "same row twice " * 30, "en", "b", 1),
        (6, "same row twice " * 30, "en", "b", 1),
        (7, "same row twice " * 30, "en", "b", 1),
        (8, "emoji \U0001f600 and ▁ marks here <|endoftext|>", "en", "c", 1),
    ]
    rows = [(*row, "x", 7, "y", "z", 1, "h", "k") for row in rows]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, row string, bits long, "
        "body string, found string, score int, host string, key string",
    )
