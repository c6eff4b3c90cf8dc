import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows."""

    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def rows_of():
    def collect(df, *columns):
        return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)

    return collect
