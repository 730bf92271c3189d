import pytest


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (id, text) as documents with clashing extra columns."""

    def make(rows):
        rows = [(i, t, "en", "s", 1, 7, True) for i, t in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, bits int, score boolean"
        )

    return make
