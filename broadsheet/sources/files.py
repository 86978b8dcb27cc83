"""Text files: articles, manifest, IDF dictionary and stop-word list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import time_to_epoch
from ..functions.fixed_values import (
    KEYWORD_STOP_WORDS,
    MANIFEST_HEADER_LEFT,
    MANIFEST_HEADER_RIGHT,
    MANIFEST_SEPARATOR,
)

# Articles hold line breaks, so records in a file are parted by the ASCII record separator.
RECORD_SEPARATOR = "\x1e"


def _one_line(name: str) -> Column:
    """A field that fills exactly one line: null is empty, line breaks become a space."""
    return F.regexp_replace(F.coalesce(F.col(name).cast("string"), F.lit("")), r"[\r\n\x1e]+", " ")


def article_text(articles: DataFrame) -> DataFrame:
    """``(url, day, value)``: title, url, time and body on successive lines; day as YYYYMMDD.

    A null field is an empty line, so no field moves up; line breaks in title, url and time become
    spaces, and so does a record separator in the body.
    """
    body = F.translate(F.coalesce("content", F.lit("")), RECORD_SEPARATOR, " ")
    return articles.select(
        "url",
        F.date_format(F.to_timestamp("time"), "yyyyMMdd").alias("day"),
        F.concat_ws("\n", _one_line("title"), _one_line("url"), _one_line("time"), body).alias("value"),
    )


def write_article_text(articles: DataFrame, path: str) -> None:
    """Article texts in one folder per day; many articles share a file."""
    article_text(articles).select("day", "value").write.mode("overwrite").option(
        "lineSep", RECORD_SEPARATOR
    ).partitionBy("day").text(path)


def read_article_text(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Articles ``(title, url, time, content)`` from text; a body keeps its line breaks.

    ``one_per_file`` reads files that hold a single article each.
    """
    if one_per_file:
        raw = spark.read.text(path, wholetext=True)
    else:
        raw = spark.read.text(path, lineSep=RECORD_SEPARATOR)
    part = F.split("value", "\n", 4)
    return raw.select(
        *(F.get(part, i).alias(n) for i, n in enumerate(("title", "url", "time", "content")))
    )


def manifest_lines(entries: DataFrame) -> DataFrame:
    """``(epoch, url, line)`` with ``line = site###title###path###epoch``, sorted by time.

    Null fields are empty. Inside a field a run of separator characters becomes one such character,
    and those at its ends go.
    """

    def entry(name: str) -> Column:
        mark = MANIFEST_SEPARATOR[0]
        inner = F.regexp_replace(_one_line(name), f"{mark}{{2,}}", mark)
        return F.regexp_replace(inner, f"^{mark}|{mark}$", "")

    epoch = time_to_epoch(F.col("time")).cast("double")
    return (
        entries.withColumn("epoch", epoch)
        .orderBy("epoch", "url")
        .select(
            "epoch",
            "url",
            F.concat_ws(
                MANIFEST_SEPARATOR,
                entry("site"),
                entry("title"),
                entry("path"),
                F.coalesce(F.col("epoch").cast("decimal(20,1)").cast("string"), F.lit("")),
            ).alias("line"),
        )
    )


def write_manifest(entries: DataFrame, path: str, written_at: str) -> None:
    """Sorted manifest text under ``path``, part files in order, the header line in front."""
    spark = entries.sparkSession
    header = spark.range(1).select(
        F.lit(float("-inf")).alias("epoch"),
        F.lit("").alias("url"),
        F.lit(MANIFEST_HEADER_LEFT + written_at + MANIFEST_HEADER_RIGHT).alias("line"),
    )
    lines = header.unionByName(manifest_lines(entries))
    lines.orderBy("epoch", "url").select("line").write.mode("overwrite").text(path)


def read_idf(spark: SparkSession, path: str) -> DataFrame:
    """IDF dictionary of ``word freq`` lines as ``(term, idf)``; the last line of a word wins.

    The place of a line is its file, then its offset in reading order inside the file.
    """
    part = F.split(F.trim("value"), " ")
    lines = spark.read.text(path).select(
        F.get(part, 0).alias("term"),
        F.get(part, 1).cast("double").alias("idf"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
    )
    return lines.groupBy("term").agg(F.max_by("idf", "place").alias("idf"))


def write_idf(idf: DataFrame, path: str) -> None:
    idf.select(F.concat_ws(" ", "term", F.col("idf").cast("string"))).write.mode(
        "overwrite"
    ).text(path)


def read_stop_words(spark: SparkSession, path: str) -> DataFrame:
    """Stop words: the lines of the file as they stand, added to the defaults."""
    defaults = spark.createDataFrame([(w,) for w in KEYWORD_STOP_WORDS], "term string")
    return spark.read.text(path).toDF("term").union(defaults).distinct()
