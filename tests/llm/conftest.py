import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns that operators use inside."""
    rows = [
        (1, "The same text, twice.", "en", "a", 21),
        (2, "the SAME text, twice.", None, None, None),
        (3, None, "en", "a", None),
        (4, "", "en", "a", 0),
        (5, "x", "en", "b", 1),
        (6, "word " * 40_000, "en", "b", 200_000),
        (7, "one two three four", "en", "b", 18),
        (7, "one two three four", "en", "b", 18),
        (None, "no identifier here at all", "en", "b", 5),
        (9, "ÄÖ  tab\tand\r\nline \x1c end  ", "de", "b", 5),
        (10, "日本語 のテキスト 12345 's don't", "ja", "b", 5),
    ]
    extra = "digest string, kept string, node string, length string, tokens string, rest string, _score string"
    names = SCHEMA + ", " + extra
    return spark.createDataFrame([(*r, *["z"] * 7) for r in rows], names).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
