import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and repeated texts, and columns whose names clash with working names."""
    rows = [(1, "One line here.\nAnother line of text, longer than the first one by far.", 7, "x"), (2, None, 7, None), (3, "", 7, ""), (4, "One line here.\nAnother line of text, longer than the first one by far.", 7, "x"), (4, "twice", 8, "y"), (5, "  \n\n ", 9, "z"), (6, "a" * 5000, 1, "q"), (7, "é漢字 <|endoftext|> don't   stop\n\n x", 1, "q")]
    return spark.createDataFrame(rows, "doc_id long, text string, fp int, tx string")
