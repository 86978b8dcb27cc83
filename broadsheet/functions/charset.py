"""GB2312 text.

Spark 4 accepts this charset only under its legacy charset settings, which an expression reads when
it is built. They are therefore set around the building of the expression and put back after it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHARSET = "GB2312"
REPLACEMENT = "\ufffd"
_SETTINGS = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")


@contextmanager
def java_charsets(spark: SparkSession) -> Iterator[None]:
    """Any Java charset; bad input becomes a replacement character instead of failing the job."""
    before = {name: spark.conf.get(name) for name in _SETTINGS}
    for name in _SETTINGS:
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def decode_pages(raw: DataFrame, data: str = "data", text: str = "html") -> DataFrame:
    """Strictly decoded pages: a page with a byte that is not GB2312 is dropped.

    A bad byte decodes to the replacement character, which GB2312 itself cannot encode.
    """
    with java_charsets(raw.sparkSession):
        decoded = raw.withColumn(text, F.decode(F.col(data), CHARSET))
    return decoded.filter(~F.contains(F.col(text), F.lit(REPLACEMENT))).drop(data)


def encode_text(df: DataFrame, text: str, data: str) -> DataFrame:
    """GB2312 bytes of the text without the characters that the charset does not have."""
    with java_charsets(df.sparkSession):
        there_and_back = F.decode(F.encode(F.col(text), CHARSET), CHARSET)
        kept = F.array_join(_common(F.split(text, ""), F.split(there_and_back, "")), "")
        return df.withColumn(data, F.encode(kept, CHARSET))


def _common(chars: Column, mapped: Column) -> Column:
    """Characters that came back unchanged; an unmappable one comes back as a question mark."""
    pairs = F.filter(
        F.zip_with(chars, mapped, lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        lambda p: p["a"] == p["b"],
    )
    return F.transform(pairs, lambda p: p["a"])
