import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


LONG = "word " * 30_000 + "x" * 50_000


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with results."""
    rows = [
        (1, None, 1, "a"), (2, "", 1, "b"), (3, " \n\t ", None, None), (4, "Same text here.", 2, "c"), (4, "Same text here.", 2, "c"),
        (5, "Same text here.", 2, "c"), (None, "No id, mail a@b.org", 3, "d"), (None, None, None, None), (6, LONG, 1, "e"),
        (7, "émoji 😀 und größer – ok", 1, "f"), (8, "one two", 1, "g"), (9, "one two", 1, "g"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, labels string")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_words int, labels string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
