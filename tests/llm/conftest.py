import duckdb
import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A small documents table from texts or (id, text) or whole rows."""

    def make(rows, extra=""):
        full = []
        for i, row in enumerate(rows):
            if not isinstance(row, tuple):
                row = (i, row)
            if len(row) == 2:
                key, text = row
                row = (key, text, "en", f"src{i % 3}", len(text) if text is not None else None)
            full.append(row)
        return spark.createDataFrame(full, DOCS + extra)

    return make


@pytest.fixture
def duck():
    return duckdb.connect()
