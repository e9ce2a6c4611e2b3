import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs over some partitions, with a clashing extra column."""

    def make(rows, parts=3, **columns):
        full = [(i, t, columns.get("lang", "en"), "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts).selectExpr("*", "'x' AS digest", "1 AS kept")

    return make
