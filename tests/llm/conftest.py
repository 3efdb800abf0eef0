import pytest

LONG = "word " * 40_000 + "end"


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, an empty and a very long text, ties, repeated rows and extra columns with clashing names."""
    rows = [
        (1, "One two three four five six seven eight nine ten.\nA second line here.", "en", "a", 70, 1, "x"),
        (2, None, None, None, None, None, None),
        (3, "", "en", "a", 0, 2, "y"),
        (None, "a text without an id", "en", None, 3, None, "z"),
        (4, "the same row twice", "en", "a", 5, 4, "w"),
        (4, "the same row twice", "en", "a", 5, 4, "w"),
        (5, "the same row twice", "en", "b", 5, 4, "w"),
        (4, "another text of the same id", "en", "a", 5, 4, "w"),
        (6, LONG, "en", "a", 7, 5, "v"),
        (7, " \t\n\x0b\x0c\r ", "en", "a", 7, 5, "v"),
        (8, "éİ\U0001f600   \x00 nul <|endoftext|> x y  z", "en", "a", 7, 5, "v"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, length long, rank string"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def none(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
