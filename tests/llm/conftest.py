import pytest

from tests.conftest import spark  # noqa: F401 - the same session

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):  # noqa: F811
    """Rows with nulls, empty and long texts, ties, repeated rows and clashing further columns."""
    base = " ".join(f"word{i}" for i in range(120))
    near = base.replace("word60", "other")
    far = " ".join(f"thing{i % 90}" for i in range(200))
    rows = [(1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, "en", "b", None),
            (4, far, None, "a", 2), (5, None, "en", None, 3), (6, "", None, None, None),
            (7, "a b", "de", "a", 4), (8, "A  B\n", "de", "a", 4), (None, far, "fr", "c", 5),
            (None, None, None, None, None), (9, "tab\tx " + "long " * 30_000, "en", "a", 6),
            (9, "tab\tx " + "long " * 30_000, "en", "a", 6), (10, "# $ % | < > " * 30, "en", "a", 7),
            (11, "ü" * 5000, "en", "a", 8), (12, base + " " + far, "en", "a", 9)]
    return spark.createDataFrame([(*r, "x", "y", 0) for r in rows],
                                 DOCS + ", key string, h string, label long")


@pytest.fixture
def no_docs(spark):  # noqa: F811
    return spark.createDataFrame([], DOCS)


def rows_by_text(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
