import pytest
from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 20_000

#: Nulls, empty and blank texts, a very long one, repeated rows, and columns whose names operators use themselves.
ODD = [
    (1, "One two three four five six.\nseven eight", "en", "a", 3),
    (1, "One two three four five six.\nseven eight", "en", "a", 3),
    (2, None, None, None, None),
    (None, "a text without an id", "en", "a", 1),
    (3, "", "de", "", 0),
    (4, " \n\t ", "de", "b", 4),
    (5, LONG, "en", "a", len(LONG)),
    (6, "ein <|endoftext|> Wort ß  \r\n\n mehr \U0001f600", "de", "b", 9),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The rows above with extra columns named like results."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(ODD, schema)
    clashing = ("score", "predicted", "ids", "print", "kept", "rate", "copies", "tokens", "n_words", "n_dropped", "distance", "h1", "key")
    return docs.selectExpr("*", *(f"'x' as {c}" for c in clashing))


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i // 2) % 2) for i in range(40)] + [(1, None, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture
def documents(spark):
    def make(texts, **columns):
        rows = texts if isinstance(texts, list) and texts and isinstance(texts[0], tuple) else list(enumerate(texts))
        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
        return spark.createDataFrame(rows, schema)

    return make
