import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Makes a documents table, with an extra column of a working name, from (doc_id, text, source) rows."""

    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t), "x") for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA + ", part string").repartition(3)

    return make


#: Rows no operator may stumble over: null ids, texts and sources, empty, blank, long and repeated ones.
ODD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t", None),
    (4, "word", "b"),
    (4, "word", "b"),
    (None, "no id here", "b"),
    (None, None, None),
    (5, "long " * 60_000, "c"),
    (6, "é中\U0001f600   á <|endoftext|> It's 12", "c"),
    (7, "two words", "b"),
]


@pytest.fixture
def odd():
    return list(ODD)
