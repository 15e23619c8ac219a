import pytest

SF = "/root/testdata/sf0.001"

#: A text of each awkward kind, for every operator.
AWKWARD = [
    (1, "plain words here, and a few more of them.\nA second line.", "en", "s1"),
    (2, None, "en", "s1"),
    (3, "", None, "s2"),
    (4, "   \t\n ", "de", None),
    (5, "plain words here, and a few more of them.\nA second line.", "en", "s2"),
    (5, "plain words here, and a few more of them.\nA second line.", "en", "s2"),  # a repeated row
    (6, "x" * 5000, None, "s1"),
    (7, "12345 67890 !!", "en", "s3"),
    (None, "ünï cödé 漢字 \U0001f600 don't they're  two  spaces\r\n\r\n   end", "fr", "s1"),
    (8, "long text of many words " * 4000, "en", "s1"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Awkward rows with extra columns whose names the operators use inside."""
    rows = [(*r, 7, "x", 1.5) for r in AWKWARD]
    return spark.createDataFrame(rows, SCHEMA + ", row_id bigint, ids string, size double")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
