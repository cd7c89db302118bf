import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, fp long, w string, id string, part int"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with further columns named like the operators' working columns."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", None, None, "k", 1, "w", "x", 3) for i, t in rows], SCHEMA)

    return make


def prose(seed, words, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"{draw.choice('bcdfgklmnprst')}{draw.choice('aeiou')}{draw.choice('lmnrst')}{draw.randrange(vocabulary) // 9 % 7 * 'o'}" for _ in range(words))


ODD_TEXTS = [None, "", "   \n\t ", "A", "12 34 !!", "\x1c\x1d", "日本語 テスト\n\né́ ﬁ 🙂", "one two", "<|endoftext|> a", "x" * 3000, prose(1, 2000)]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Null ids, repeated ids and rows, and texts at the edges."""
    rows = list(enumerate(ODD_TEXTS)) + [(None, "A"), (None, None), (3, "A"), (3, "another text"), (50, prose(1, 2000))]
    return make_docs(rows)


@pytest.fixture(scope="session")
def no_docs(make_docs, odd_docs):
    return odd_docs.limit(0)
