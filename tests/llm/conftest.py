import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, slot string, label int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and blank texts, a very long one, repeated rows, and columns with clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog. " * 12, "en", "a", 5, 0.5, "x", 1),
        (2, "The quick brown fox jumps over the lazy dog. " * 12, "en", "a", 5, 0.5, "x", 1),
        (3, None, None, None, None, None, None, None),
        (4, "", "en", "b", 0, 0.1, "y", 0),
        (5, " \t\n ", "en", "b", 0, 0.1, "y", 0),
        (6, " ".join(f"word{i}" for i in range(60_000)), "de", "c", 1, 0.2, "z", 1),
        (7, "one", "fr", None, 1, None, None, None),
        (7, "one", "fr", None, 1, None, None, None),
        (7, "other words here", "fr", None, 1, None, None, None),
        (None, "without an id but with some words", None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None),
        (8, "Ärger über größere Füße 🙂 <|endoftext|> Σς", "de", "d", 9, 0.3, "w", 1),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
