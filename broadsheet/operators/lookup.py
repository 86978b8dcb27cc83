"""Batch lookup: keywords to postings to articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_within, written

# Keywords, and the urls they hit, are broadcast within both bounds and joined by shuffle beyond.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20


def lookup_term(index: DataFrame, keyword: str) -> DataFrame:
    """Posting lists of one term; the equality reaches the Parquet reader."""
    return index.filter(F.col("term") == keyword)


def lookup_terms(index: DataFrame, keywords: DataFrame) -> DataFrame:
    """Posting lists of many keywords, ``(keyword, part, urls)``.

    An empty or unknown keyword gives no row. Keywords within the bound are counted when this is
    called and broadcast: the index is not shuffled, and the first and last keyword reach its reader.
    """
    asked = keywords.select("keyword").filter(F.col("keyword") != "").distinct()
    few = broadcast_within(asked, BROADCAST_ROWS, BROADCAST_BYTES, "keyword")
    if few is not None:
        first, last = asked.agg(F.min("keyword"), F.max("keyword")).first()
        index, asked = index.filter(F.col("term").between(first or "", last or "")), few
    return index.join(asked, F.col("term") == F.col("keyword")).select("keyword", "part", "urls")


def lookup_prefix(index: DataFrame, prefix: str) -> DataFrame:
    return index.filter(F.col("term").startswith(prefix))


def search(index: DataFrame, articles: DataFrame, keywords: DataFrame) -> DataFrame:
    """Articles of every keyword: ``(keyword, url, title, content[, time])``.

    ``time`` is there if the articles have it. A posting without an article gives empty fields. List order is url order, so sorting by
    ``(keyword, url)`` restores it. The hits are written once. Urls hit within the bound are counted when this is called and
    broadcast, so only the articles that are hit reach the join.
    """
    hits = written(
        lookup_terms(index, keywords).select("keyword", F.explode("urls").alias("url")), "hits")
    fields = ["title", "content", *(c for c in ("time",) if c in articles.columns)]
    found = articles.select("url", *fields)
    urls = hits.select("url").distinct()
    few = broadcast_within(urls, BROADCAST_ROWS, BROADCAST_BYTES, "url")
    if few is not None:
        found = found.join(few, "url", "left_semi")
    return hits.join(found, "url", "left").select("keyword", "url", *fields)
