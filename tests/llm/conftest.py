"""Small frames shared by the operators' tests."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n int, value string, rep long"
EDGE = [
    (1, None, "en", "a", 0, 1, "x", 1),
    (2, "", "en", None, 0, 1, "x", 1),
    (3, "   \n\t ", None, "a", 0, 1, "x", 1),
    (4, "one", "en", "b", 3, 1, "x", 1),
    (5, "ONE two  three four five six", "en", "b", 0, 1, None, 1),
    (6, "one two three four five six", "en", "b", 0, None, "x", None),
    (6, "one two three four five six", "en", "b", 0, None, "x", None),
    (None, "one two three four five six", "en", "b", None, 1, "x", 1),
    (7, "wörd ünd <|endoftext|> 日本 語 " * 3000, "de", "c", 0, 1, "x", 1),
    (8, "a b c d e f g h", None, None, None, None, None, None),
]


@pytest.fixture
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, extra columns with names that operators use."""
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def thue_morse(n, first="a", second="b"):
    """The Thue-Morse string of n letters: with its complement it collides under polynomial hashes modulo 2**64."""
    return "".join((first, second)[bin(k).count("1") % 2] for k in range(n))


@pytest.fixture(scope="session")
def twins():
    """Pairs of different strings that polynomial hashes modulo 2**64 take for equal."""
    return [(thue_morse(n), thue_morse(n, "b", "a")) for n in (1024, 2048, 4096)]
