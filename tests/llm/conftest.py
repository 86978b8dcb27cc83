import pytest
from pyspark.sql import types as T

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("row", T.StringType()), T.StructField("score", T.StringType()), T.StructField("fp", T.StringType()),
    T.StructField("place", T.StringType()), T.StructField("base", T.StringType()), T.StructField("found", T.StringType()),
    T.StructField("words", T.StringType()), T.StructField("length", T.StringType()), T.StructField("salt", T.StringType()),
])


@pytest.fixture
def make_docs(spark):
    """Documents with extra columns whose names clash, from (doc_id, text) pairs."""
    def make(*rows):
        full = [(i, t, "en", "s", len(t or ""), "r", None, "f", "p", "b", "x", "w", "l", "z") for i, t in rows]
        return spark.createDataFrame(full, DOC)

    return make
