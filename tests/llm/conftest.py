import pytest

#: Copies, near copies, ties, repeated rows, nulls, empty, blank and long texts.
_BASE = " ".join(f"word{i % 37} tail{i}" for i in range(60))
TEXTS = [
    (1, _BASE),
    (2, _BASE),
    (3, _BASE + " extra"),
    (4, "Un été à la plage, l'eau était froide. " * 3),
    (5, ""),
    (6, None),
    (7, " \t\n\x0b\f\r "),
    (8, "one"),
    (9, "One"),
    (10, "two words"),
    (11, "日本語のテキスト" * 30),
    (12, "prefix " + _BASE[100:400] + " suffix"),
    (13, ("long text with many words and numbers 12345 " * 4000) + _BASE),
    (13, ("long text with many words and numbers 12345 " * 4000) + _BASE),
    (14, "a" * 300 + _BASE[:60]),
    (15, "a" * 300),
    (16, "ONE!! TWO!! THREE### <a|b> $$$ %%% &&&\n\nONE!! TWO!!\n" * 5),
    (None, "a row without an id but with some words in it " + _BASE[200:300]),
    (None, None),
    (17, "<|endoftext|> special <|startoftext|> strings"),
]


@pytest.fixture(scope="session")
def edge_rows():
    return list(TEXTS)


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows with extra columns whose names clash with inner ones."""
    rows = [(i, t, "xx", "s", 5, 7, 8, True, "z", b"q") for i, t in edge_rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, n int, "
              "g long, is_train boolean, digest string, items binary").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, "
                                     "n_chars long, words string")
