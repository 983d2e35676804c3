import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, n int, h string, node long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties,
    and extra columns whose names operators use inside."""
    long_text = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    rows = [
        (1, "one two three four five six seven", "en", "src0", 5, "a", 1, "x", 1),
        (1, "one two three four five six seven", "en", "src0", 5, "a", 1, "x", 1),
        (2, "one two three four five six seven", None, None, None, None, None, None, None),
        (3, None, "en", "src1", 0, "b", 2, "y", 2),
        (4, "", "en", "src1", 0, "b", 2, "y", 2),
        (None, "one two three four five six seven", "en", "src2", 1, "c", 3, "z", 3),
        (None, None, None, None, None, None, None, None, None),
        (5, long_text, "de", "elsewhere", 1, "d", 4, "z", 4),
        (6, long_text + " end", "de", "elsewhere", 1, "d", 4, "z", 4),
        (7, " \t\n ", "de", "src3", 3, "e", 5, "z", 5),
        (8, "two words", "de", "src3", 3, "e", 5, "z", 5),
        (1, "another text for the same id, of more words", "en", "src4", 9, "f", 6, "z", 6),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
