import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _taken string, content long"
LONG = "word " * 30_000


def document(doc_id, text, source="a"):
    return (doc_id, text, "en", source, len(text or ""), "clash", 7)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([document(*r) for r in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty and very long texts, repeated rows, columns with odd names."""
    rng = random.Random(5)
    words = ["the", "of", "house", "Token:", "é", "漢字", "x"]
    return make_docs([
        (1, None), (2, ""), (3, "  \n "), (4, LONG, "b"), (5, "one"), (5, "one"), (None, "null id"), (None, None, None),
        (6, "no source here", None), (7, "<|endoftext|> a  b\n\nc ▁ \t"),
        *[(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))), "abc"[k % 3]) for k in range(10, 60)],
    ])
