import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(texts, first=0):
        """A documents table of (id, text) pairs or texts."""
        rows = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], DOCS)
    return make
