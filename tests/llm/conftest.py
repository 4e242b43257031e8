import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Work tables need a folder that the driver and the executors share; on one machine any will do."""
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield


ODD = [(1, None), (2, ""), (3, " \t\n \r"), (None, "word"), (4, "one two three"), (4, "one two three"), (5, "x" * 20000), (6, "a b " * 6000)]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, repeated rows, a very long word and a very long text, and clashing extra columns."""
    rows = [(d, t, "en", i, "extra") for i, (d, t) in enumerate(ODD)]
    names = "doc_id long, text string, lang string, score int, items string"
    return spark.createDataFrame(rows, names)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, score int, items string")


@pytest.fixture(scope="session")
def documents(spark):
    import os

    folder = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    return spark.read.parquet(f"{folder}/documents.parquet")
