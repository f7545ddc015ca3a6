import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, __extra string"


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text, lang, source), with a column more than documents have."""

    def make(rows):
        full = [(*row, *(None,) * (4 - len(row)))[:4] for row in rows]
        return spark.createDataFrame([(*r, len(r[1] or ""), "more") for r in full], DOCS)

    return make


#: Texts that every operator must bear: null, empty, blank, one word, ties, repeats, signs, long.
ODD_TEXTS = [
    None, "", " \t\n", "word", "word", "a b c", "A B C", "ünïcödé ▁   漢字 🙂", "x" * 3000, "no end " * 4000, "\x00 nul \x1f",
]


@pytest.fixture
def odd_docs(make_docs):
    rows = [(k, text, "en", "s") for k, text in enumerate(ODD_TEXTS)]
    return make_docs(rows + [(None, "word", None, None), (None, None, None, None), (3, "word", "en", "s"), (3, "word", "en", "s")])
