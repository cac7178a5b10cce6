import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Small documents with the cases every operator must define."""
    rows = [
        (1, "the cat sat on the mat and the cat sat on the mat again", "en", "b", 1),
        (2, "the cat sat on the mat and the cat sat on the mat again", "en", "a", 1),
        (3, None, "en", None, None), (4, "", None, "a", 0), (4, "", None, "a", 0),
        (None, "only a row without an id", "de", "c", 3), (5, " \t\n ", "de", None, 4),
        (6, "Straße naïve 日本語 текст 🙂 é fin", "fr", "a", 9),
        (7, "x" * 300_000, "en", "b", 300_000), (8, "lorem ipsum dolor " * 20_000, "en", "b", 360_000),
        (9, "Line one here\nLine one here\nLine two", "en", "a", 3), (9, "another text, same id", "en", "a", 3),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
