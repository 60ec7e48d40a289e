import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def document(doc_id, text, lang="en", source="s"):
    return doc_id, text, lang, source, None if text is None else len(text)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows):
        return spark.createDataFrame([document(*r) for r in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def odd(documents):
    """Missing, empty, blank, very long, repeated texts and ids, and a missing id."""
    long = "the quick brown fox and " * 20_000
    return documents([
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, "same words here"), (5, "same words here"), (6, "same words here"), (None, "no id"),
        (7, "Ünïcødé 💥 \x00 tail"),
    ])


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) if columns else tuple(r) for r in df.collect()), key=repr)
