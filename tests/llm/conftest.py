import pytest

from tests.conftest import spark  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def frame(spark):  # noqa: F811
    """A documents-like table from (doc_id, text) pairs, with columns that clash with results."""
    def make(rows):
        schema = "doc_id long, text string, n_words string, chunk int, key string, id long, source string"
        return spark.createDataFrame([(i, t, "x", 1, "k", 9, "s") for i, t in rows], schema)
    return make
