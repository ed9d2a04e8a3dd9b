import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from texts or (id, text) pairs, with further columns after those."""

    def make(texts, lang="en", source="a", more="", values=()):
        rows = []
        for place, text in enumerate(texts):
            name, text = text if isinstance(text, tuple) else (place, text)
            rows.append((name, text, lang, source, len(text or ""), *values))
        return spark.createDataFrame(rows, DOCS + (", " + more if more else ""))

    return make


@pytest.fixture
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make


@pytest.fixture
def benchmark(spark):
    def make(items):
        return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")

    return make
