import pytest

LONG = "The cat sat on the mat, and 'twas 12345 o'clock.\n" * 6000


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, a null
    id, and extra columns whose names the operators use for results."""
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "...  !!", "en", "a", 7),
            (4, LONG, "en", "b", len(LONG)), (5, "a b c d", "fr", "b", 7), (5, "a b c d", "fr", "b", 7),
            (6, "other words here", "de", None, 16), (None, "a text without id", "en", "c", 17),
            (7, "日本語のテキスト 🙂", None, "c", 10)]
    rows = [(*r, 0.5, "x", 3, False, "k", 9) for r in rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "score double, fp string, n_tokens int, held_out boolean, spans string, "
                                       "rank int")


@pytest.fixture(scope="session")
def empty_docs(edge_docs):
    return edge_docs.limit(0)
