import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark, tmp_path_factory):
    """Documents from texts, ids from 0; columns that operators make themselves are there too, with other values."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))

    def make(*texts, langs=None, ids=None):
        ids = range(len(texts)) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        rows = [(i, t, lang, "s", 7, "clash", -1, True) for i, t, lang in zip(ids, texts, langs)]
        return spark.createDataFrame(rows, DOCUMENTS + ", key string, n int, kept boolean")
    return make


ODD = ["", None, " \n\t ", "one", "one two", "é ñ ß 日本語 \U0001f389", "same words over and over " * 40, "same words over and over " * 40,
       "x" * 5000, "a b c d e f g h i j k l", "token = \"0123456789abcdef0123456789abcdef\"", "line\nline\nline\n\nline"]
