import pytest
from llm_tables import CLASHING, DOCS, documents


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(spark, rows):
    return spark.createDataFrame([(*r, *([1.5] * 10)) for r in rows], CLASHING)


@pytest.fixture(scope="session")
def odd_ids(spark, rows):
    """The rows with two of them repeated, two ids shared by different texts, and some ids null."""
    more = rows[:20] + [rows[0], rows[1], (rows[2][0], "another text of its own", "en", "s1", 1), (None, rows[3][1], "en", "s1", 1),
                        (None, rows[3][1], "en", "s1", 1), (None, "no id and no other copy", "en", None, 1), (None, None, None, None, None)]
    return spark.createDataFrame(more, DOCS)
