"""Small tables with every odd case that the operators define."""

import random

import pytest

# other columns carry names that operators may use for their own
CLASHING = "body string, key bigint, node bigint, slice int, ids binary, score double, size int, shard int, component string, sketch string, text_key int"


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): copies, repeated rows, ties, NULLs, empty and very long texts."""
    long = words(1, 30_000)
    base = words(2, 60)
    near = " ".join(base.split()[:57] + ["other", "words", "here"])
    return [(5, base, "en", "a"), (6, base.upper(), "en", "b"), (7, near, "fr", "a"), (8, words(3, 50), None, None), (8, words(3, 50), None, None),
            (9, None, "en", "a"), (10, "", "en", "c"), (11, " \n\t ", "en", "c"), (12, "one two", "en", "c"), (13, "One TWO", "en", "d"),
            (None, base, "en", "a"), (None, None, None, None), (14, long, "en", "a"), (15, long + " end", "en", "a"), (16, "é漢字 🎉 naïve  text\n\n x", "fr", "b"),
            (17, "a" * 5000, "en", "a")]


@pytest.fixture(scope="session")
def make_docs(spark):
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"

    def make(rows):
        filler = ("b", 1, 2, 3, b"x", 0.5, 4, 5, "c", "s", 6)
        return spark.createDataFrame([(i, t, lang, source, None if t is None else len(t), *filler) for i, t, lang, source in rows], schema)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_rows):
    return make_docs(odd_rows)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
