import pytest


@pytest.fixture
def docs(spark):
    """``docs((id, text), ...)`` with the columns of documents."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return lambda *rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema)
