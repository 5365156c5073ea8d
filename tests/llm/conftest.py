import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, _size long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, extra columns with clashing names."""
    long = " ".join(f"wort{i % 977}" for i in range(120_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1, "x", 1),
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a", 1, "x", 1),
        (1, "quite another text under the same id", "en", None, 1, "x", 1),
        (2, None, None, None, None, None, None),
        (3, "", "en", "b", 0, "x", 1),
        (4, " \t\n ", "de", "b", 0, "x", 1),
        (None, "a text without an id", "en", "b", 0, "x", 1),
        (5, long, "de", "c", 0, "x", 1),
        (6, long + " ende", "de", "c", 0, "x", 1),
        (7, "THE QUICK brown fox jumps over the lazy dog again and again", "en", "a", 1, "x", 1),
        (8, "1234 5678", "en", "a", 1, "x", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
