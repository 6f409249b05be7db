import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `size` string, `row` int, ids string, mix int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank, long and repeated texts, repeated ids, columns that clash with results."""
    texts = [
        (1, "The cat sat on the mat and the dog ran off.", "en", "b"),
        (2, "The cat sat on the mat and the dog ran off.", "en", "b"),
        (3, "THE CAT sat on the mat and the dog ran off!", None, "a"),
        (4, None, "en", "b"),
        (5, "", "de", None),
        (6, " \n\t ", "de", None),
        (7, "word " * 30_000, "en", "c"),
        (8, "x" * 100_000, "fr", "c"),
        (9, "Licensed under CC BY-NC 4.0.\nsome other line", "en", "é"),
        (9, "Licensed under CC BY-NC 4.0.\nsome other line", "en", "é"),
        (9, "another text under one id", "en", "a"),
        (None, "a text without id <|endoftext|> 12 34 ß Σ", "es", "a"),
        (None, None, None, None),
        (10, "12 + 34 = 46", None, "a"),
        (11, "一二三 é à 👍🏽 \u0301 \u1c00", "fr", "Z"),
    ]
    rows = [(i, t, lang, src, None, "clash", 5, "clash", 7) for i, t, lang, src in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
