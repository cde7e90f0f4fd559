from __future__ import annotations

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(seed: int, n: int = 60) -> str:
    """Words that no other seed gives in this order."""
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(n))


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text); other columns are null."""

    def make(*rows):
        return spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCUMENTS)

    return make


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and columns with clashing names."""
    long_text = " ".join(sentence(k, 400) for k in range(12)) + " " + "x" * 5000
    rows = [
        (1, None), (2, ""), (None, None), (None, sentence(1)), (3, sentence(2)), (3, sentence(2)),
        (4, "Zwei Wörter"), (5, long_text), (6, "   \n\t  "), (7, "ß \x00 é<|endoftext|> 　日本語 👩‍👩‍👧"), (8, sentence(2)),
    ]
    extra = "k1 long, k2 string, node string, bands string, ids string, score string, matches string, dt string"
    return spark.createDataFrame(
        [(d, t, None, "s", None, 9, *["c"] * 7) for d, t in rows], f"{DOCUMENTS}, {extra}"
    )


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
