import pytest

from tests.llm.brute import edge_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
CLASHES = ["kept", "id", "hash", "row", "sha", "slot", "c0", "__id", "__sha", "words", "n_words", "node", "doc"]


@pytest.fixture(scope="session")
def edges():
    return edge_rows()


@pytest.fixture(scope="session")
def docs(spark, edges):
    """The edge rows with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in edges], SCHEMA + "".join(f", `{c}` string" for c in CLASHES)).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def real(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
