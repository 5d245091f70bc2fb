import random

import pytest

COLUMNS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, print int, score string,"
    " words string, row int, node int, start int, length int, n int, key int, kept int, _row int, first string"
)


@pytest.fixture(scope="session")
def vocabulary():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(400)]


@pytest.fixture(scope="session")
def odd_texts(vocabulary):
    """(doc_id, text): nulls, empty and blank texts, copies, repeated ids, a very long text, odd characters."""
    rng = random.Random(7)
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = prose(120)
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (None, base), (None, None), (5, base), (6, base), (6, base),
        (7, base + " end"), (8, prose(60)), (8, prose(70)), (9, prose(30_000)), (10, "one"), (11, "one two"),
        (12, "a b c a b c\n" * 40), (13, "  lead  and  runs   \n\n of\tspace  "), (14, "naïve Ünïcode ▁ K 漢字 🎉🎉 <|endoftext|> x<|endoftext|>"),
        (15, "x" * 5000), (16, "licensed under CC BY now, cc by!\nAll rights reserved"),
    ]
    return rows + [(20 + i, prose(80)) for i in range(30)]


@pytest.fixture
def docs_of(spark):
    """A documents table whose other columns have names that operators might use themselves."""

    def make(rows):
        extra = ("l", "s", 1, "d", 2, "x", "w", 3, 4, 5, 6, 7, 8, 9, 1, "f")
        return spark.createDataFrame([(*r, *extra) for r in rows], COLUMNS)

    return make


@pytest.fixture
def odd_docs(docs_of, odd_texts):
    return docs_of(odd_texts)


@pytest.fixture
def no_docs(docs_of):
    return docs_of([])
