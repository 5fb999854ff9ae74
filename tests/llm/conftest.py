import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and long texts, repeated rows and clashing further columns."""
    long = "lorem ipsum dolor sit amet " * 4000
    texts = [None, "", " \n\t", "a", "one two", "one two", long, "x" * 50_000, "é漢字 😀 naïve", "one two three four five six",
             "One TWO three four five six"]
    rows = [(i, t, "en", "src", 0, "clash", 1.5) for i, t in enumerate(texts)]
    rows += [rows[9], (None, "no id here at all", None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "sig string, kept double")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
