import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs, or from full rows."""

    def make(rows, schema=DOCS):
        full = [tuple(r) + ("en", "src0", len(r[1] or ""))[: 5 - len(r)] if len(r) < 5 else tuple(r) for r in rows]
        return spark.createDataFrame(full, schema)

    return make
