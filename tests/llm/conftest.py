import pytest

from eventloom.llm.common import on_workers

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    on_workers(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts or (doc_id, text, lang, source) rows."""

    def make(rows):
        full = [(k, r, "en", "s", len(r or "")) if r is None or isinstance(r, str) else (*r, len(r[1] or "")) for k, r in enumerate(rows)]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns that clash with results."""
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, "word " * 30_000, "en", "a", 150_000), (4, "\n\n", None, "b", 2),
        (5, "Some words here.\nAnd a line that is longer than forty characters, surely.", "en", None, 70),
        (5, "Some words here.\nAnd a line that is longer than forty characters, surely.", "en", None, 70),
        (6, "x" * 50_000, "fr", "b", 50_000), (None, "an id is missing here", "en", "b", 21), (7, " \t\r ", "en", "a", 4),
    ]
    extra = "size long, target double, taken long, component_id long, kept boolean, score double, shard long, rep long, k1 long, n long, slice long, _keys string"
    wide = [(*r, 1, 1.0, 1, 1, True, 0.5, 1, 1, 1, 1, 1, "x") for r in rows]
    return spark.createDataFrame(wide, f"{DOCS}, {extra}")
