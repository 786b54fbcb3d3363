import pytest

from shiplog.llm.common import share_package

#: Null and empty texts, a repeated row, a very long word, white space only.
ODD = [(None, None), (1, None), (2, ""), (3, "   \n\t "), (4, "word"), (4, "word"), (5, "x" * 5000), (6, "é ñ ß 日本 \U0001f600 .")]


@pytest.fixture(autouse=True)
def workers(spark):
    share_package(spark)


@pytest.fixture
def odd(spark):
    """Odd texts, with extra columns whose names clash with inner ones."""
    rows = [(i, t, "s", 7, "k", 0.5, None, [1]) for i, t in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, n long, key string, score double, node long, `sketch` array<int>"
    )


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, n long")
