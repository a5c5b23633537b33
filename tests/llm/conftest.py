import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows of (doc_id, text) as documents."""

    def make(rows, extra=False):
        df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
        return df.selectExpr("*", "1 AS __text", "'x' AS component_id", "0 AS score") if extra else df

    return make
