import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Nulls in any column, empty and wordless texts, a very long one, repeated rows and equal ids.
ODD_ROWS = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 3), (None, "a text without an id here", "en", None, 5),
    (4, "word " * 30_000, "en", "a", 150_000), (5, "the same row twice", "en", "a", 1), (5, "the same row twice", "en", "a", 1),
    (5, "an equal id with another text", "de", "b", 2), (6, "###$$$ !!! ,,, 123", "xx", "b", 3), (7, "éÀ ß 漢字 😀 x\x1cy", "fr", "b", 4),
]


@pytest.fixture
def docs(spark):
    return lambda rows: spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], DOCS)


@pytest.fixture
def odd(docs):
    return docs(ODD_ROWS)


@pytest.fixture
def none(docs):
    return docs([])
