import pytest

from graphloom.llm.queries import tokenizer_path

ODD = "doc_id long, text string, lang string, source string, n_chars long, kept string, score int, text2 string, fingerprint int, n_lines string, _d int, epoch string, _row int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, one long text, and names that operators use themselves."""
    long = " ".join(f"word{i % 977} and line{i} of{i * i}.\n" for i in range(20000))
    texts = [(1, "A b c d e f."), (2, None), (3, ""), (4, " \n\t "), (None, "null id"), (5, "same text here"), (5, "same text here"), (6, "Same  TEXT here"), (7, long), (8, "ünïcödé ﬁ 漢字 😀 x"), (9, "one"), (None, None)]
    rows = [(i, t, None if k % 2 else "en", None if k % 3 == 0 else f"s{k % 2}", None, "k", 1, "t", 2, "n", 3, "e", 4) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, ODD).repartition(3)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (5, 0, 1), (None, 1, 1), (7, None, None), (1, 0, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def tokenizer():
    return tokenizer_path()
