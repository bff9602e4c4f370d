import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source), with extra columns on demand."""
    def make(rows, extra=None):
        df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS)
        return df.selectExpr("*", *extra) if extra else df
    return make


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
