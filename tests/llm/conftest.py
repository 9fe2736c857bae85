import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Makes a documents table from texts, or from (doc_id, text[, lang[, source]]) rows."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            doc_id, text, lang, source = (*row, "en", "src0")[:4] if isinstance(row, tuple) and len(row) < 4 else row if isinstance(row, tuple) else (i, row, "en", "src0")
            if isinstance(row, tuple) and len(row) == 3:
                source = "src0"
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        return spark.createDataFrame(full, DOCUMENTS)

    return make
