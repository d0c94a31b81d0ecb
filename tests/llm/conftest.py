import pytest

TEXTS = {
    1: "The same words, here. And there!\nA second line of text.",
    2: None,
    3: "",
    4: "a " * 9000,
    5: "The same words, here. And there!\nA second line of text.",
    6: "<|endoftext|> 'tis I'm é ́x 12 ...!!! ！漢字 İ\x1cb x y",
    7: "\n \t\n",
}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and columns whose names clash with results."""
    rows = [(k, t, None if k == 3 else "en", "s", len(t or ""), "x", "y") for k, t in TEXTS.items()]
    return spark.createDataFrame(rows + [rows[0], (None, "a null id", None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
