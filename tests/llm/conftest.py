import pytest


@pytest.fixture
def docs(spark):
    """Documents from texts, numbered, with extra columns whose names the operators use, too."""

    def make(*texts, first=0):
        rows = [(i, t, "en", "s", None, 1, "x") for i, t in enumerate(texts, first)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, id int, hits string"
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def empty(docs):
    return docs("x").limit(0)


@pytest.fixture
def odd(spark):
    """A null text, an empty one, one of white space, a repeated row, a null id, one word, a very long text."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "same text"), (4, "same text"), (None, "no id"), (5, "one"), (6, "long word " * 30_000)]
    return spark.createDataFrame(rows, "doc_id long, text string")
