import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp long, h string, ids string, row string, _base string, shard string, kept_id long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns named as operators might name theirs."""
    words = "the quick brown fox jumps over the lazy dog and runs away from all of the hounds that follow it "
    texts = [
        (0, words * 3, "en", "a"), (1, words * 3, "en", "b"), (2, words * 3 + "once more", "en", "a"), (3, "", "en", "a"), (4, None, None, None), (5, "   \n\t ", "fr", ""),
        (6, words * 3000, "en", "b"), (7, "un deux trois quatre cinq six sept huit neuf dix onze douze treize " * 4, "fr", "b"), (8, "123 !!! 456", None, "c"),
        (None, words * 2, "en", None), (None, None, None, None), (9, "eins zwei drei vier fünf sechs sieben acht neun zehn " * 5, "de", "c"), (9, "eins zwei drei vier fünf sechs sieben acht neun zehn " * 5, "de", "c"),
    ]
    return spark.createDataFrame([(*t, None, 1, "x", "y", "z", "b", "s", 5) for t in texts], DOCS)


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)
