import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a small documents table with every column nullable, a clashing extra one, and repeated rows if wanted."""

    def make(rows, extra="score"):
        full = [(i, text, lang, "src", None if text is None else len(text), 1.5) for i, text, lang in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {extra} double")

    return make
