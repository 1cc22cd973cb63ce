"""Small tables with the cases every operator must settle."""

import random

import pytest

SYLLABLES = ["ka", "lo", "mi", "ter", "un", "ve", "sol", "par", "ing", "dro"]


def sentence(draw: random.Random, words: int) -> str:
    return " ".join("".join(draw.choices(SYLLABLES, k=draw.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_texts():
    """NULL, empty, blank, tiny, repeated, very long and special texts."""
    draw = random.Random(4)
    long = sentence(draw, 30_000)
    plain = sentence(draw, 60)
    return [None, "", " \n\t", "a", "Über 漢字 😀", plain, plain, plain + " more words here", long, "it's <|endoftext|> ok", " x y"]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The odd texts with clashing extra columns, a NULL id and a repeated row."""
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", None, 1.5, "x") for i, t in enumerate(odd_texts)]
    rows += [rows[5], (None, "text without an id", "en", None, 3, None, None)]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, id string"
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
